"""Row hashes and hash keys, computed in the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def row_hash(columns: Iterable[str | Column]) -> Column:
    """md5 over the row as JSON; NULLs are written out, so (NULL, 'a') <> ('a', NULL).

    Timestamps are written to the microsecond.
    """
    return F.md5(F.to_json(F.struct(*columns), {
        "ignoreNullFields": "false", "timestampFormat": MICROSECONDS, "timestampNTZFormat": MICROSECONDS,
    }))


def hub_key(*business_key: str | Column) -> Column:
    """Hash key of a business key: trimmed, upper case, parts joined by ``||``."""
    parts = [
        F.upper(F.trim((F.col(k) if isinstance(k, str) else k).cast("string")))
        for k in business_key
    ]
    if len(parts) == 1:
        return F.md5(parts[0])
    return F.md5(F.concat_ws("||", *[F.coalesce(p, F.lit("")) for p in parts]))


def link_key(*hub_keys: str | Column) -> Column:
    """Hash key of a link: md5 over the hub keys it joins, in order."""
    return F.md5(F.concat_ws("||", *hub_keys))
