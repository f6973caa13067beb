"""Timestamps without zone and calendar attributes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Validity bounds of versioned rows.
ORIGIN = "1900-01-01 00:00:00"
FOREVER = "9999-01-01 00:00:00"

# Month and day names.
MONTHS_EN = (
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
)
MONTHS_RU = (
    "Января", "Февраля", "Марта", "Апреля", "Мая", "Июня", "Июля",
    "Августа", "Сентября", "Октября", "Ноября", "Декабря",
)
DAYS_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
QUARTERS = ("First", "Second", "Third", "Fourth")


def ntz(value: str | date | datetime | Column) -> Column:
    """Literal (or column) as timestamp without zone, folded at planning."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def _named(names: Sequence[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def month_name(d: Column, names: Sequence[str] = MONTHS_EN) -> Column:
    return _named(names, F.month(d))


def date_key(d: Column) -> Column:
    """Integer yyyymmdd by arithmetic, no text formatting."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def day_title(day: Column, month: Column, year: Column) -> Column:
    """``1 January 2022``; a NULL part is empty, both blanks stay."""
    parts = [F.coalesce(p.cast("string"), F.lit("")) for p in (day, month, year)]
    return F.concat(parts[0], F.lit(" "), parts[1], F.lit(" "), parts[2])


def day_title_or_null(day: Column, month: Column, year: Column) -> Column:
    """``1 January 2022``; NULL when a part is NULL."""
    return F.concat(day.cast("string"), F.lit(" "), month, F.lit(" "), year.cast("string"))


def _iso_day(d: Column) -> Column:
    return F.weekday(d) + 1


def _ordinal(day: Column) -> Column:
    ending = (
        F.when(day.between(11, 13), "th")
        .when(day % 10 == 1, "st")
        .when(day % 10 == 2, "nd")
        .when(day % 10 == 3, "rd")
        .otherwise("th")
    )
    return F.concat(day.cast("string"), ending)


def calendar_columns(
    d: Column,
    months: Sequence[str] = MONTHS_EN,
    days: Sequence[str] = DAYS_EN,
) -> list[Column]:
    """The 29 calendar attributes of date ``d``."""
    iso_day = _iso_day(d)
    week_start = F.trunc(d, "week")
    quarter_start = F.trunc(d, "quarter")
    columns = {
        "date_dim_pk": date_key(d),
        "date_actual": d,
        "epoch": F.unix_date(d).cast("long") * 86400,
        "day_suffix": _ordinal(F.day(d)),
        "day_name": _named(days, iso_day),
        "day_of_week": iso_day,
        "day_of_month": F.day(d),
        "day_of_quarter": F.datediff(d, quarter_start) + 1,
        "day_of_year": F.dayofyear(d),
        "week_of_month": F.ceil(F.day(d) / 7).cast("int"),
        "week_of_year": F.weekofyear(d),
        "week_of_year_iso": F.concat(
            F.extract(F.lit("YEAROFWEEK"), d).cast("string"),
            F.lit("-W"),
            F.lpad(F.weekofyear(d).cast("string"), 2, "0"),
            F.lit("-"),
            iso_day.cast("string"),
        ),
        "month_actual": F.month(d),
        "month_name": month_name(d, months),
        "month_name_abbreviated": F.substring(month_name(d, MONTHS_EN), 1, 3),
        "quarter_actual": F.quarter(d),
        "quarter_name": _named(QUARTERS, F.quarter(d)),
        "year_actual": F.year(d),
        "first_day_of_week": week_start,
        "last_day_of_week": F.date_add(week_start, 6),
        "first_day_of_month": F.trunc(d, "month"),
        "last_day_of_month": F.last_day(d),
        "first_day_of_quarter": quarter_start,
        "last_day_of_quarter": F.last_day(F.add_months(quarter_start, 2)),
        "first_day_of_year": F.trunc(d, "year"),
        "last_day_of_year": F.make_date(F.year(d), F.lit(12), F.lit(31)),
        "mmyyyy": F.date_format(d, "MMyyyy"),
        "mmddyyyy": F.date_format(d, "MMddyyyy"),
        "weekend_indr": iso_day >= 6,
    }
    return [expression.alias(name) for name, expression in columns.items()]
