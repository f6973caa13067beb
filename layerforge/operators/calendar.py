"""Calendar dimension."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.functions.dates import DAYS_EN, MONTHS_EN, calendar_columns, date_key, month_name

def days(spark: SparkSession, start: date | str, n: int) -> DataFrame:
    """``n`` consecutive dates as column ``d``."""
    first = F.lit(str(start)).cast("date")
    return spark.range(n).select(F.date_add(first, F.col("id").cast("int")).alias("d"))


def days_between(df: DataFrame, columns: Sequence[str]) -> tuple[date, int]:
    """First day and number of days the date columns span (one row to the driver)."""
    lo = F.least(*[F.min(F.to_date(c)) for c in columns]) if len(columns) > 1 else F.min(
        F.to_date(columns[0])
    )
    hi = F.greatest(*[F.max(F.to_date(c)) for c in columns]) if len(columns) > 1 else F.max(
        F.to_date(columns[0])
    )
    low, high = df.agg(lo, hi).first()
    return (low, (high - low).days + 1) if low is not None else (date(1900, 1, 1), 0)


def calendar_dim(
    spark: SparkSession,
    start: date | str,
    n: int,
    months: Sequence[str] = MONTHS_EN,
    day_names: Sequence[str] = DAYS_EN,
) -> DataFrame:
    """Calendar with 29 columns."""
    return days(spark, start, n).select(*calendar_columns(F.col("d"), months, day_names))


def calendar_small(
    spark: SparkSession, start: date | str, n: int, months: Sequence[str] = MONTHS_EN
) -> DataFrame:
    """Calendar with the five columns the layered reports use."""
    d = F.col("d")
    return days(spark, start, n).select(
        date_key(d).alias("date_id"),
        d.alias("date_actual"),
        F.day(d).alias("day_of_month"),
        month_name(d, months).alias("month_name"),
        F.year(d).alias("year"),
    )
