"""Small scalar rules, each a function on Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two greeting texts of the time-of-day rule.
WOKE_BEFORE_FIVE = "Вы проснулись до 5 утра"
WOKE_AFTER_FIVE = "Вы проснулись после 5 утра"


def larger_of(a: Column, b: Column, tie: Column | int | None = None) -> Column:
    """Larger value; ``tie`` (NULL by default) when equal, ``b`` when either is NULL."""
    tie_value = tie if isinstance(tie, Column) else F.lit(tie)
    return F.when(a == b, tie_value).when(a > b, a).otherwise(b)


def first_non_null(*values: Column) -> Column:
    """First argument that is not NULL; any type, at least two arguments."""
    return F.coalesce(*values)


def times_five(value: Column) -> Column:
    return value * F.lit(5)


def wake_label(
    ts: Column, before: str = WOKE_BEFORE_FIVE, after: str = WOKE_AFTER_FIVE
) -> Column:
    """Label by time of day; 05:00:00 itself still counts as before five.

    Seconds since midnight keep the fraction, so 05:00:00.5 is after five.
    """
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts)
    return F.when(seconds <= 5 * 3600, before).otherwise(after)


def contains_text(value: Column, fragment: str) -> Column:
    """Case-insensitive match; ``%`` and ``_`` inside the fragment stay wildcards."""
    return value.ilike(f"%{fragment}%")
