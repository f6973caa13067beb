"""Analytic functions, calendar and reports."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from layerforge.functions.dates import date_key
from layerforge.functions.scalars import first_non_null, larger_of, times_five, wake_label
from layerforge.operators import calendar as C
from layerforge.operators import checks
from layerforge.operators.history import add_history_columns
from layerforge.plans import reports
from layerforge.sources import standins as S
from registered.base import (
    AFTER,
    BEFORE,
    CALENDAR,
    PAYMENT_ROWS,
    RENTAL_ROWS,
    film,
    inventory,
    payment,
    register,
    rental,
    sql_text,
    text,
    with_,
)


def calendar_span(spark, sf_dir) -> tuple[date, int]:
    """Whole years around all dates of the test tables, and the year after."""
    shipped = C.days_between(S.table(spark, sf_dir, "lineitem"), ["l_shipdate"])
    ordered = C.days_between(S.table(spark, sf_dir, "orders"), ["o_orderdate"])
    ends = [start + timedelta(n - 1) for start, n in (shipped, ordered)]
    first = date(min(shipped[0], ordered[0]).year, 1, 1)
    return first, (date(max(ends).year + 1, 12, 31) - first).days + 1


def calendar(spark, sf_dir):
    return C.calendar_dim(spark, *calendar_span(spark, sf_dir))


def small_calendar(spark, sf_dir):
    return C.calendar_small(spark, *calendar_span(spark, sf_dir))


# --- reports -----------------------------------------------------------------

TITLE = "c.day_of_month || ' ' || c.month_name || ' ' || c.year_actual"


@register("sales_by_date", with_(f"""
SELECT {TITLE} AS date_title, CAST(sum(amount) AS DECIMAL(18,2)) AS amount,
  c.date_dim_pk AS date_sort
FROM p JOIN c ON c.date_actual = CAST(p.payment_date AS DATE)
GROUP BY 1, 3""", p=PAYMENT_ROWS, c=CALENDAR))
def sales_by_date(spark, sf_dir):
    fact = S.payment_rows(spark, sf_dir).select(
        "amount", date_key(F.col("payment_date")).alias("payment_date_fk")
    )
    return reports.sales_by_date_star(fact, calendar(spark, sf_dir)).withColumn(
        "amount", F.col("amount").cast("decimal(18,2)")
    )


@register("sales_by_date_live", with_(f"""
SELECT c.date_dim_pk AS sales_date_rn, {TITLE} AS sales_date_title,
  CAST(sum(amount) AS DOUBLE) AS amount
FROM p JOIN c ON c.date_actual = CAST(p.payment_date AS DATE)
WHERE deleted IS NULL GROUP BY 1, 2""", p=PAYMENT_ROWS, c=CALENDAR))
def sales_by_date_live(spark, sf_dir):
    return reports.sales_by_date(S.payment_rows(spark, sf_dir), small_calendar(spark, sf_dir))


@register("sales_by_title", with_("""
SELECT p_name AS film_title, CAST(sum(amount) AS DECIMAL(18,2)) AS amount
FROM p JOIN part ON p_partkey = film_id GROUP BY p_name""", p=PAYMENT_ROWS))
def sales_by_title(spark, sf_dir):
    rows = S.payment_rows(spark, sf_dir)
    fact = rows.select((F.col("film_id") * 10 + F.col("line")).alias("inventory_fk"), "amount")
    disks = rows.select("film_id", "line").distinct()
    films = S.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title")
    )
    dim = disks.join(films, "film_id").select(
        (F.col("film_id") * 10 + F.col("line")).alias("inventory_pk"), "title"
    )
    return reports.sales_by_title_star(fact, dim).withColumn(
        "amount", F.col("amount").cast("decimal(18,2)")
    )


@register("sales_by_item", with_("""
SELECT f.film_id AS sales_film_rn, f.title AS sales_film_title,
  CAST(sum(p.amount) AS DOUBLE) AS amount
FROM p JOIN r ON r.rental_id = p.rental_id JOIN i ON i.inventory_id = r.inventory_id
  JOIN f ON f.film_id = i.film_id
WHERE p.deleted IS NULL AND r.deleted IS NULL GROUP BY 1, 2""",
    p=payment(AFTER), r=rental(AFTER), i=inventory(AFTER), f=film(AFTER)))
def sales_by_item(spark, sf_dir):
    return reports.sales_by_film(
        S.payment(spark, sf_dir, AFTER),
        S.rental(spark, sf_dir, AFTER),
        add_history_columns(S.inventory(spark, sf_dir, AFTER)),
        add_history_columns(S.film(spark, sf_dir, AFTER)),
    )


# --- analytic functions ------------------------------------------------------


@register("counts_by_function", with_("""
SELECT film_id, f.title AS film_title,
  (SELECT count(*) FROM i WHERE i.film_id = f.film_id) AS count_inventory_film,
  count(*) AS count_rental_film
FROM f JOIN i USING (film_id) JOIN r USING (inventory_id)
WHERE f.rating IN ('Brand#1', 'Brand#2') GROUP BY film_id, f.title""",
    f=film(AFTER), i=inventory(AFTER), r=rental(AFTER)))
def counts_by_function(spark, sf_dir):
    return reports.film_counts(
        S.film(spark, sf_dir, AFTER),
        S.inventory(spark, sf_dir, AFTER),
        S.rental(spark, sf_dir, AFTER),
        ["Brand#1", "Brand#2"],
    )


FILM_SHOWN = 7


@register("payments_per_day", with_(f"""
SELECT CAST(date_trunc('day', payment_date) AS TIMESTAMP) AS payment_day,
  CAST(sum(amount) AS DECIMAL(18,2)) AS amount
FROM i JOIN r USING (inventory_id) JOIN p USING (rental_id)
WHERE i.film_id = {FILM_SHOWN} AND amount <> 0 GROUP BY 1 ORDER BY 1""",
    p=payment(AFTER), r=rental(AFTER), i=inventory(AFTER)))
def payments_per_day(spark, sf_dir):
    return reports.amount_per_day(
        S.payment(spark, sf_dir, AFTER),
        S.rental(spark, sf_dir, AFTER),
        S.inventory(spark, sf_dir, AFTER),
        FILM_SHOWN,
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))


@register("rating_stats", with_("""
SELECT last_name, rating AS film_rating, count(*) AS total_count_film,
  CAST(sum(amount) AS DOUBLE) / count(*) AS avg_amount_per_film,
  CAST(sum(disks) AS DOUBLE) / count(*) AS avg_count_disk_per_film
FROM (SELECT DISTINCT s_name AS last_name, l_partkey AS film_id, p_brand AS rating
      FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey)
  LEFT JOIN (
    SELECT film_id, amount, disks
    FROM (SELECT i.film_id, sum(p.amount) AS amount
          FROM p JOIN r USING (rental_id) JOIN i ON i.inventory_id = r.inventory_id GROUP BY 1)
      JOIN (SELECT film_id, count(*) AS disks FROM i GROUP BY 1) USING (film_id)
  ) USING (film_id)
GROUP BY 1, 2 HAVING sum(disks) IS NOT NULL""",
    p=payment(AFTER), r=rental(AFTER), i=inventory(AFTER)))
def rating_stats(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem")
    return reports.rating_stats(
        S.table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("film_id"), F.col("p_brand").alias("rating")
        ),
        lines.select(F.col("l_partkey").alias("film_id"), F.col("l_suppkey").alias("actor_id")),
        S.table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("actor_id"), F.col("s_name").alias("last_name")
        ),
        S.inventory(spark, sf_dir, AFTER),
        S.rental(spark, sf_dir, AFTER),
        S.payment(spark, sf_dir, AFTER),
    )


@register("title_by_duration", "SELECT p_name AS title FROM part WHERE p_size = 5")
def title_by_duration(spark, sf_dir):
    part = S.table(spark, sf_dir, "part").select(
        F.col("p_name").alias("title"), F.col("p_size").alias("rental_duration")
    )
    return reports.titles_by_duration(part, 5)


@register("title_search",
          "SELECT p_name AS title FROM part WHERE p_name ILIKE '%' || 'R_N' || '%'")
def title_search(spark, sf_dir):
    part = S.table(spark, sf_dir, "part").select(F.col("p_name").alias("title"))
    return reports.titles_containing(part, "R_N")


@register("larger_of_two", with_("""
SELECT rental_id,
  CASE WHEN a > b THEN a WHEN a = b THEN NULL ELSE b END AS larger,
  CASE WHEN a > b THEN a WHEN a = b THEN 0 ELSE b END AS larger_tie_zero,
  CASE WHEN b > a THEN b WHEN a = b THEN NULL ELSE a END AS larger_swapped
FROM (SELECT rental_id, CAST(day(rental_date) AS INT) AS a, CAST(day(return_date) AS INT) AS b
      FROM r)""", r=RENTAL_ROWS))
def larger_of_two(spark, sf_dir):
    a, b = F.day("rental_date"), F.day("return_date")
    return S.rental_rows(spark, sf_dir).select(
        "rental_id",
        larger_of(a, b).alias("larger"),
        larger_of(a, b, tie=0).alias("larger_tie_zero"),
        larger_of(b, a).alias("larger_swapped"),
    )


@register("first_non_null", with_("""
SELECT rental_id, coalesce(return_date, rental_date) AS of_two,
  coalesce(deleted, return_date, rental_date) AS of_three FROM r""", r=RENTAL_ROWS))
def first_non_null_(spark, sf_dir):
    c = F.col
    return S.rental_rows(spark, sf_dir).select(
        "rental_id",
        first_non_null(c("return_date"), c("rental_date")).alias("of_two"),
        first_non_null(c("deleted"), c("return_date"), c("rental_date")).alias("of_three"),
    )


@register("scale_by_five", "SELECT p_partkey AS film_id, p_size * 5 AS scaled FROM part")
def scale_by_five(spark, sf_dir):
    return S.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("film_id"), times_five(F.col("p_size")).alias("scaled")
    )


@register("time_of_day_label", """
SELECT event_id, CASE WHEN CAST(ts AS TIME) <= TIME '05:00:00'
  THEN 'Вы проснулись до 5 утра' ELSE 'Вы проснулись после 5 утра' END AS label
FROM events""")
def time_of_day_label(spark, sf_dir):
    return S.table(spark, sf_dir, "events").select(
        "event_id", wake_label(F.col("ts")).alias("label")
    )


@register("counts_by_group",
          "SELECT p_brand AS rating, count(*) AS total_count_film FROM part GROUP BY 1")
def counts_by_group(spark, sf_dir):
    return S.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("rating")).agg(
        F.count("*").alias("total_count_film")
    )


# --- calendar ----------------------------------------------------------------


def _days(table: str, column: str) -> str:
    return f"""SELECT CAST(unnest(generate_series(
      (SELECT min({column}) FROM {table}), (SELECT max({column}) FROM {table}),
      INTERVAL 1 DAY)) AS DATE) AS d"""


@register("calendar_dim", with_("""
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_dim_pk, d AS date_actual,
  CAST(epoch(d) AS BIGINT) AS epoch,
  day(d) || CASE WHEN day(d) IN (11, 12, 13) THEN 'th' WHEN day(d) % 10 = 1 THEN 'st'
    WHEN day(d) % 10 = 2 THEN 'nd' WHEN day(d) % 10 = 3 THEN 'rd' ELSE 'th' END AS day_suffix,
  strftime(d, '%A') AS day_name, CAST(isodow(d) AS INT) AS day_of_week,
  CAST(day(d) AS INT) AS day_of_month,
  CAST(d - CAST(date_trunc('quarter', d) AS DATE) + 1 AS INT) AS day_of_quarter,
  CAST(dayofyear(d) AS INT) AS day_of_year,
  CAST((day(d) - 1) // 7 + 1 AS INT) AS week_of_month, CAST(week(d) AS INT) AS week_of_year,
  strftime(d, '%G-W%V-%u') AS week_of_year_iso, CAST(month(d) AS INT) AS month_actual,
  strftime(d, '%B') AS month_name, strftime(d, '%b') AS month_name_abbreviated,
  CAST(quarter(d) AS INT) AS quarter_actual,
  CASE quarter(d) WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third'
    ELSE 'Fourth' END AS quarter_name,
  CAST(year(d) AS INT) AS year_actual,
  CAST(d + CAST(1 - isodow(d) AS INT) AS DATE) AS first_day_of_week,
  CAST(d + CAST(7 - isodow(d) AS INT) AS DATE) AS last_day_of_week,
  CAST(date_trunc('month', d) AS DATE) AS first_day_of_month,
  CAST(date_trunc('month', d) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS last_day_of_month,
  CAST(date_trunc('quarter', d) AS DATE) AS first_day_of_quarter,
  CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
    AS last_day_of_quarter,
  make_date(year(d), 1, 1) AS first_day_of_year, make_date(year(d), 12, 31) AS last_day_of_year,
  strftime(d, '%m%Y') AS mmyyyy, strftime(d, '%m%d%Y') AS mmddyyyy,
  isodow(d) IN (6, 7) AS weekend_indr
FROM days""", days=_days("lineitem", "l_shipdate")))
def calendar_dim(spark, sf_dir):
    start, n = C.days_between(S.table(spark, sf_dir, "lineitem"), ["l_shipdate"])
    return C.calendar_dim(spark, start, n)


@register("calendar_small", with_("""
SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_id, d AS date_actual,
  CAST(day(d) AS INT) AS day_of_month,
  list_extract(['Января', 'Февраля', 'Марта', 'Апреля', 'Мая', 'Июня', 'Июля', 'Августа',
    'Сентября', 'Октября', 'Ноября', 'Декабря'], CAST(month(d) AS INT)) AS month_name,
  CAST(year(d) AS INT) AS year
FROM days""", days=_days("orders", "o_orderdate")))
def calendar_small(spark, sf_dir):
    from layerforge.functions.dates import MONTHS_RU

    start, n = C.days_between(S.table(spark, sf_dir, "orders"), ["o_orderdate"])
    return C.calendar_small(spark, start, n, MONTHS_RU)


# --- inspection and validation -------------------------------------------------

SOURCES = ("part", "supplier", "nation", "region", "customer", "orders", "lineitem", "events")


@register("table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in SOURCES))
def table_counts(spark, sf_dir):
    return checks.table_counts({t: S.table(spark, sf_dir, t) for t in SOURCES})


@register("newest_rows", f"""
SELECT event_id, user_id, {sql_text('ts')} AS ts FROM events ORDER BY events.ts DESC, event_id""")
def newest_rows(spark, sf_dir):
    from layerforge.operators.delta import newest_rows

    events = S.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return newest_rows(events, "ts", "event_id").withColumn("ts", text("ts"))


@register("domain_check", """
SELECT o_orderkey, 'o_orderstatus' AS violated FROM orders
WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL
SELECT o_orderkey, 'order_year' AS violated FROM orders
WHERE year(o_orderdate) NOT BETWEEN 1996 AND 2000""")
def domain_check(spark, sf_dir):
    orders = S.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("order_year")
    )
    return checks.domain_violations(
        orders, {"o_orderstatus": ["F", "O"]}, {"order_year": (1996, 2000)}
    ).select("o_orderkey", "violated")


@register("key_violations", with_("""
SELECT 'duplicate' AS kind, l_orderkey * 10 + l_linenumber AS key, count(*) AS n
FROM lineitem GROUP BY 2 HAVING count(*) > 1
UNION ALL
SELECT 'orphan' AS kind, rental_id AS key, count(*) AS n
FROM p WHERE rental_id NOT IN (SELECT rental_id FROM r) GROUP BY 2""",
    p=payment(AFTER), r=rental(BEFORE)))
def key_violations(spark, sf_dir):
    lines = S.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("key")
    )
    twice = checks.duplicate_keys(lines, ["key"])
    orphans = checks.orphan_keys(
        S.payment(spark, sf_dir, AFTER), "rental_id", S.rental(spark, sf_dir, BEFORE), "rental_id"
    )
    return twice.select(F.lit("duplicate").alias("kind"), "key", "n").unionByName(
        orphans.select(F.lit("orphan").alias("kind"), F.col("rental_id").alias("key"), "n")
    )
