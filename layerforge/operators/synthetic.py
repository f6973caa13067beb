"""Appending generated rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerforge.functions.dates import ntz
from layerforge.operators.delta import Stamp


def pick(row: Column, seed: str, low: int, high: int) -> Column:
    """Repeatable choice from ``low..high`` by row number: same rows on any retry.

    60 bits of a hash, so every id up to 2^60 above ``low`` can be chosen.
    """
    return _number(row, seed) % F.lit(high - low + 1) + F.lit(low)


def _number(row: Column, seed: str) -> Column:
    """60 bits of a hash of row number and seed."""
    digest = F.md5(F.concat_ws(":", row.cast("string"), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def id_range(table: DataFrame, column: str) -> tuple[int, int]:
    """Smallest and largest id (one row to the driver)."""
    return tuple(table.agg(F.min(column), F.max(column)).first())


def synthetic_rentals(
    rental: DataFrame,
    n: int,
    ranges: dict[str, tuple[int, int]],
    load_ts: Stamp,
    dt: date | str | None = None,
    step_days: int = 1,
) -> DataFrame:
    """``n`` rentals of one day with foreign keys picked from id ranges.

    Without ``dt`` the day follows the last rental date by ``step_days``. The
    return date is seven days later; ids continue after the largest.
    """
    last_id, last_date = rental.agg(
        F.max("rental_id"), F.max("rental_date").cast("timestamp_ntz")
    ).first()
    start = ntz(dt) if dt is not None else ntz(last_date) + F.make_dt_interval(F.lit(step_days))
    row = F.col("id")
    return rental.sparkSession.range(n).select(
        (row + F.lit(last_id) + 1).alias("rental_id"),
        start.alias("rental_date"),
        (start + F.expr("INTERVAL 7 DAYS")).alias("return_date"),
        *[pick(row, c, lo, hi).alias(c) for c, (lo, hi) in ranges.items()],
        ntz(load_ts).alias("last_update"),
    )


def fill_random(table: DataFrame, column: str, n: int, seed: int) -> DataFrame:
    """Mean of the whole column after ``n`` uniforms from [0, 1) are appended.

    The uniforms are hashes of the row number: the same on any partitioning.
    """
    uniform = _number(F.col("id"), str(seed)) / F.lit(float(1 << 60))
    added = table.sparkSession.range(n).select(uniform.alias(column))
    return table.select(column).unionByName(added).agg(F.avg(column).alias("avg_value"))
