"""Registry, load times and the SQL form of the stand-in tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Load times. Rows shipped before each are known to that load; the last one is
# the year before validity ends, so it sees every row there can be.
EARLY = "1997-01-01 00:00:00"
BEFORE = "2000-07-01 00:00:00"
AFTER = "9998-01-01 00:00:00"
RELOADED = "9998-06-01 00:00:00"


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def text(column: str | Column) -> Column:
    """Timestamp as text: year 9999 does not fit the nanosecond range of some clients."""
    c = F.col(column) if isinstance(column, str) else column
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def texts(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: text(c) for c in columns})


def versions(df: DataFrame, *columns: str) -> DataFrame:
    """Result form of versioned rows."""
    return texts(
        df.select(*columns, "effective_date_from", "effective_date_to", "is_active"),
        "effective_date_from", "effective_date_to",
    )


# --- SQL ---------------------------------------------------------------------

AMOUNT = """CAST(CAST(l_extendedprice AS DECIMAL(10,2))
    * (CAST(1 AS DECIMAL(1,0)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(8,2))"""
ORIGIN = "TIMESTAMP '1900-01-01 00:00:00'"
FOREVER = "TIMESTAMP '9999-01-01 00:00:00'"


def sql_text(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"


def _states(keys: str, as_of: str) -> str:
    return f"""(SELECT * FROM (
      SELECT *, min(l_shipdate) OVER (PARTITION BY {keys}) AS first_date,
        row_number() OVER (PARTITION BY {keys} ORDER BY l_shipdate DESC, l_orderkey DESC,
          l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
          l_extendedprice DESC, l_discount DESC, l_returnflag DESC, l_linestatus DESC) AS rn
      FROM lineitem WHERE l_shipdate < TIMESTAMP '{as_of}') WHERE rn = 1)"""


def _known(stamp: str, as_of: str) -> str:
    return f"CASE WHEN {stamp} < TIMESTAMP '{as_of}' THEN {stamp} END"


def _deleted(as_of: str) -> str:
    return f"""CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
      THEN {_known("l_shipdate + INTERVAL 30 DAY", as_of)} END"""


def film(as_of: str) -> str:
    return f"""SELECT p_partkey AS film_id, p_name AS title, p_type AS description,
      2006 AS release_year, 1 AS language_id, CAST(l_quantity AS INT) AS rental_duration,
      CAST(p_retailprice AS DECIMAL(12,2)) AS rental_rate, p_size AS length,
      CAST(p_retailprice AS DECIMAL(12,2)) AS replacement_cost, p_brand AS rating,
      l_shipdate AS last_update
    FROM {_states("l_partkey", as_of)} JOIN part ON p_partkey = l_partkey"""


def inventory(as_of: str) -> str:
    return f"""SELECT l_partkey * 10 + l_linenumber AS inventory_id, l_partkey AS film_id,
      l_suppkey AS store_id, l_shipdate AS last_update, {_deleted(as_of)} AS deleted
    FROM {_states("l_partkey, l_linenumber", as_of)}"""


def rental(as_of: str) -> str:
    back = f"""CASE WHEN l_returnflag = 'A'
      THEN {_known("l_shipdate + INTERVAL 7 DAY", as_of)} END"""
    return f"""SELECT l_orderkey * 10 + l_linenumber AS rental_id, first_date AS rental_date,
      l_partkey * 10 + l_linenumber AS inventory_id, o_custkey AS customer_id,
      {back} AS return_date, l_suppkey AS staff_id,
      coalesce({back}, l_shipdate) AS last_update, {_deleted(as_of)} AS deleted
    FROM {_states("l_orderkey, l_linenumber", as_of)} JOIN orders ON o_orderkey = l_orderkey"""


def payment(as_of: str) -> str:
    return f"""SELECT l_orderkey * 10 + l_linenumber AS payment_id, o_custkey AS customer_id,
      l_suppkey AS staff_id, l_orderkey * 10 + l_linenumber AS rental_id,
      l_partkey * 10 + l_linenumber AS inventory_id, {AMOUNT} AS amount,
      CAST(l_quantity AS INT) AS units, first_date AS payment_date,
      l_shipdate AS last_update, {_deleted(as_of)} AS deleted
    FROM {_states("l_orderkey, l_linenumber", as_of)} JOIN orders ON o_orderkey = l_orderkey"""


def staff(as_of: str) -> str:
    return f"""SELECT s_suppkey AS staff_id, s_name AS first_name, 'of ' || s_name AS last_name,
      s_nationkey AS address_id, s_name || '@example.org' AS email, s_suppkey AS store_id,
      l_linestatus = 'O' AS active, s_name AS username, l_returnflag AS password,
      l_shipdate AS last_update, {_deleted(as_of)} AS deleted
    FROM {_states("l_suppkey", as_of)} JOIN supplier ON s_suppkey = l_suppkey"""


PLACE = """SELECT s_suppkey AS store_id, n_name AS address,
      'district of ' || n_name AS district, r_name AS city_name
    FROM supplier JOIN nation ON n_nationkey = s_nationkey
      JOIN region ON r_regionkey = n_regionkey"""

# From the first day of the year of the oldest row to the end of the year after the newest.
CALENDAR = """SELECT CAST(d AS DATE) AS date_actual,
      CAST(strftime(d, '%Y%m%d') AS INT) AS date_dim_pk,
      CAST(day(d) AS INT) AS day_of_month, strftime(d, '%B') AS month_name,
      CAST(year(d) AS INT) AS year_actual
    FROM (SELECT unnest(generate_series(low, high, INTERVAL 1 DAY)) AS d FROM (
      SELECT date_trunc('year', least(a, c)) AS low,
        date_trunc('year', greatest(b, e)) + INTERVAL 2 YEAR - INTERVAL 1 DAY AS high
      FROM (SELECT min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem),
        (SELECT min(o_orderdate) AS c, max(o_orderdate) AS e FROM orders)))"""

PAYMENT_ROWS = f"""SELECT l_orderkey AS rental_id, l_partkey AS film_id, l_suppkey AS staff_id,
      l_linenumber AS line, {AMOUNT} AS amount, l_shipdate AS payment_date,
      CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_shipdate END AS deleted
    FROM lineitem"""

RENTAL_ROWS = """SELECT o_orderkey AS rental_id, o_orderdate AS rental_date,
      o_custkey AS customer_id,
      CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 7 DAY END AS return_date,
      CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS deleted
    FROM orders"""

FEED = """SELECT user_id, event_id, event_type, CAST(value AS DECIMAL(12,2)) AS value,
      ts AS last_update, CASE WHEN event_type = 'error' THEN ts END AS deleted FROM events"""


def with_(select: str, **ctes: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes.items()) + "\n" + select
