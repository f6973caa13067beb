"""Registered queries, each next to the SQL that must give the same rows."""

from registered import analytics, deltas, history, stars, vaults  # noqa: F401
from registered.base import QUERIES, SQL  # noqa: F401
