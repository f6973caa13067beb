"""Scalar rules on the literal cases of the manual checks."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from layerforge.functions.dates import MONTHS_RU, ntz
from layerforge.functions.hashing import hub_key, row_hash
from layerforge.functions.scalars import (
    WOKE_AFTER_FIVE,
    WOKE_BEFORE_FIVE,
    contains_text,
    first_non_null,
    larger_of,
    times_five,
    wake_label,
)
from layerforge.operators.calendar import calendar_dim, calendar_small


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("a", "b", "tie", "want"),
    [(2, 1, None, 2), (3, 1, None, 3), (2, 4, None, 4), (4, 4, None, None), (4, 4, 0, 0),
     (None, 4, None, 4), (4, None, None, None)],
)
def test_larger_of(spark, a, b, tie, want):
    got = value(spark, larger_of(F.lit(a).cast("int"), F.lit(b).cast("int"), tie))
    assert got == want


def test_first_non_null(spark):
    n = F.lit(None)
    assert value(spark, first_non_null(F.lit(1), n)) == 1
    assert value(spark, first_non_null(n, F.lit(2), F.lit(3))) == 2
    assert value(spark, first_non_null(F.lit("1"), n, F.lit("4"))) == "1"
    assert value(spark, first_non_null(F.lit(0.5), n, F.lit(3.2))) == 0.5
    assert value(spark, first_non_null(n, n, F.lit(3.2))) == 3.2
    assert value(spark, first_non_null(n, n, n)) is None


def test_times_five(spark):
    assert value(spark, times_five(F.lit(5))) == 25


@pytest.mark.parametrize(
    ("at", "want"),
    [("2024-01-01 04:59:59", WOKE_BEFORE_FIVE), ("2024-01-01 05:00:00", WOKE_BEFORE_FIVE),
     ("2024-01-01 05:00:00.5", WOKE_AFTER_FIVE), ("2024-01-01 05:00:01", WOKE_AFTER_FIVE)],
)
def test_wake_label(spark, at, want):
    assert value(spark, wake_label(ntz(at))) == want


def test_contains_text_keeps_wildcards(spark):
    assert value(spark, contains_text(F.lit("STAR TURN"), "Tur"))
    assert value(spark, contains_text(F.lit("STAR TURN"), "t_r"))
    assert not value(spark, contains_text(F.lit("STAR"), "Tur"))


def test_row_hash_tells_nulls_apart(spark):
    one = F.struct(F.lit(None).cast("string").alias("a"), F.lit("x").alias("b"))
    two = F.struct(F.lit("x").alias("a"), F.lit(None).cast("string").alias("b"))
    assert value(spark, row_hash([one])) != value(spark, row_hash([two]))


def test_hub_key_is_trimmed_and_upper(spark):
    assert value(spark, hub_key(F.lit(" ab "))) == value(spark, hub_key(F.lit("AB")))
    assert value(spark, hub_key(F.lit("a"), F.lit(None).cast("string"))) != value(
        spark, hub_key(F.lit(None).cast("string"), F.lit("a"))
    )


def test_calendar_against_python(spark):
    start, n = date(2007, 1, 1), 5843
    rows = calendar_dim(spark, start, n).orderBy("date_actual").collect()
    assert len(rows) == n and len(rows[0]) == 29
    for i, r in enumerate(rows):
        d = start + timedelta(days=i)
        year, week, day = d.isocalendar()
        quarter = (d.month - 1) // 3
        assert r["date_actual"] == d
        assert r["date_dim_pk"] == int(d.strftime("%Y%m%d"))
        assert r["week_of_year_iso"] == f"{year}-W{week:02d}-{day}"
        assert r["day_of_quarter"] == (d - date(d.year, 3 * quarter + 1, 1)).days + 1
        assert r["week_of_month"] == (d.day - 1) // 7 + 1
        assert r["epoch"] == (d - date(1970, 1, 1)).days * 86400
        assert r["first_day_of_week"] == d - timedelta(days=day - 1)
        assert r["month_name_abbreviated"] == d.strftime("%b")
        assert r["weekend_indr"] == (day > 5)
    assert {r["day_suffix"] for r in rows} >= {"1st", "2nd", "3rd", "11th", "12th", "13th", "21st"}


def test_small_calendar_takes_month_names(spark):
    row = calendar_small(spark, "2005-01-01", 1, MONTHS_RU).first()
    assert tuple(row) == (20050101, date(2005, 1, 1), 1, "Января", 2005)


def test_row_hash_sees_microseconds(spark):
    stamps = [F.lit(f"2020-01-01 00:00:00.00000{i}").cast(kind) for kind in ("timestamp_ntz", "timestamp") for i in (1, 2)]
    hashes = [value(spark, row_hash([s.alias("at")])) for s in stamps]
    assert hashes[0] != hashes[1] and hashes[2] != hashes[3]


def test_titles_with_a_missing_month(spark):
    from layerforge.functions.dates import day_title, day_title_or_null

    parts = (F.lit(1), F.lit(None).cast("string"), F.lit(2022))
    assert value(spark, day_title(*parts)) == "1  2022"
    assert value(spark, day_title_or_null(*parts)) is None
    whole = (F.lit(1), F.lit("May"), F.lit(2022))
    assert value(spark, day_title(*whole)) == value(spark, day_title_or_null(*whole)) == "1 May 2022"


def test_one_hub_row_for_one_hash_key(spark, values):
    from layerforge.operators import vault as V

    rows = spark.createDataFrame([("a", 1), ("A", 1), (" a", 2), ("b", None), (None, 3)], "k string, n int")
    hub = V.load_hub(rows, "k", "hk", "2020-01-01", "x")
    assert values(hub, "k") == [(" a",), ("b",)]
    link = V.load_link(rows, {"h1": "k", "h2": "n"}, "lk", "2020-01-01", "x")
    assert link.count() == 2  # (a, 1) and (a, 2); a missing reference links nothing
    assert link.filter("h1 IS NULL OR h2 IS NULL").isEmpty()
    swapped = spark.createDataFrame([(1, None), (None, 1)], "a int, b int")
    assert V.load_link(swapped, {"h1": "a", "h2": "b"}, "lk", "2020-01-01", "x").isEmpty()


def test_picks_reach_the_whole_range(spark):
    from layerforge.operators.synthetic import pick

    got = [r[0] for r in spark.range(2000).select(pick(F.col("id"), "s", 1, 10**12)).collect()]
    assert min(got) >= 1 and 10**11 * 9 < max(got) <= 10**12
