"""The rental source built from the test tables.

Several ``lineitem`` rows share (order, line number); read in shipping order
they are the successive states of one order line. The state of every table as
known just before a load time follows from that, so two load times give new,
changed, deleted and unchanged rows.

    film       part, duration from its newest sale
    inventory  (part, line number); store from its newest sale
    rental     order line: disk and staff from its newest row
    payment    order line: amount from its newest row
    staff      supplier; store is the supplier's own
    store      supplier; address is its nation
    address    nation, in the city that is its region
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from layerforge.functions.dates import ntz
from layerforge.session import written_once
from layerforge.sources.readers import read_parquet

BASE_TIME = "1995-01-01 00:00:00"  # stamp of rows the test tables give no time for


# Columns of the test tables. Declared, so that reading opens no
# file footer to infer them.
TEST_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey long, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey long, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id long, ts timestamp_ntz, user_id long, event_type string,
        value double, props string""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(
        spark, f"{sf_dir}/{name}.parquet", StructType.fromDDL(TEST_TABLES[name])
    )


def line_amount() -> Column:
    """Price after discount in exact decimals, rounded half up to cents."""
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    return (price * (F.lit(1).cast("decimal(1,0)") - discount)).cast("decimal(8,2)")


# Order of the states of one key: newest first by shipping date, ties by the rest.
STATE_ORDER = (
    "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
)


def line_states(
    spark: SparkSession, sf_dir: str, keys: Sequence[str], as_of: str, take: Sequence[str],
    dealt_by: str | None = None,
) -> DataFrame:
    """Newest row per key among those shipped before ``as_of``.

    One aggregate with map-side combine: a hot key sends one row per map task.
    ``dealt_by`` names a key whose groups are small: rows are dealt by it first, so
    that no map task sorts its whole input to combine next to nothing, and a join
    on it follows without another shuffle. Rows without it are left out.
    """
    rows = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate") < ntz(as_of))
    if dealt_by is not None:
        rows = rows.filter(F.col(dealt_by).isNotNull()).repartition(dealt_by)
    # Rows of a group have the same keys: they decide nothing in its order.
    newest = rows.groupBy(*keys).agg(
        F.max(F.struct(*[c for c in STATE_ORDER if c not in keys])).alias("n"),
        F.min("l_shipdate").alias("first_date"),
    )
    return newest.select(
        *keys, "first_date", *[F.col(f"n.{c}").alias(c) for c in take if c not in keys]
    )


def _known(stamp: Column, as_of: str) -> Column:
    return F.when(stamp < ntz(as_of), stamp)


def _deleted(as_of: str) -> Column:
    """Refused and finished lines are deleted 30 days after shipping."""
    refused = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return F.when(refused, _known(F.col("l_shipdate") + F.expr("INTERVAL 30 DAYS"), as_of))


def film(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    sold = line_states(spark, sf_dir, ["l_partkey"], as_of, ["l_shipdate", "l_quantity"])
    part = table(spark, sf_dir, "part")
    return sold.join(part, sold.l_partkey == part.p_partkey).select(
        F.col("p_partkey").alias("film_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("description"),
        F.lit(2006).alias("release_year"),
        F.lit(1).alias("language_id"),
        F.col("l_quantity").cast("int").alias("rental_duration"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("rental_rate"),
        F.col("p_size").alias("length"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("replacement_cost"),
        F.col("p_brand").alias("rating"),
        F.col("l_shipdate").alias("last_update"),
    )


def _disk() -> Column:
    return F.col("l_partkey") * 10 + F.col("l_linenumber")


def inventory(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    sold = line_states(
        spark, sf_dir, ["l_partkey", "l_linenumber"], as_of,
        ["l_shipdate", "l_suppkey", "l_returnflag", "l_linestatus"],
    )
    return sold.select(
        _disk().alias("inventory_id"),
        F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_shipdate").alias("last_update"),
        _deleted(as_of).alias("deleted"),
    )


def order_lines(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    """Newest rows of the order lines whose order is known: rentals and payments are views of them."""
    lines = line_states(
        spark, sf_dir, ["l_orderkey", "l_linenumber"], as_of,
        ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
         "l_discount", "l_returnflag", "l_linestatus"], "l_orderkey",
    ).withColumn("line_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).drop("l_orderkey", "o_orderkey")


def rental(spark: SparkSession, sf_dir: str, as_of: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines as rentals; ``lines`` are those of ``order_lines`` if written before."""
    lines = order_lines(spark, sf_dir, as_of) if lines is None else lines
    back = F.when(
        F.col("l_returnflag") == "A",
        _known(F.col("l_shipdate") + F.expr("INTERVAL 7 DAYS"), as_of),
    )
    return lines.select(
        F.col("line_id").alias("rental_id"),
        F.col("first_date").alias("rental_date"),
        _disk().alias("inventory_id"),
        F.col("o_custkey").alias("customer_id"),
        back.alias("return_date"),
        F.col("l_suppkey").alias("staff_id"),
        F.coalesce(back, F.col("l_shipdate")).alias("last_update"),
        _deleted(as_of).alias("deleted"),
    )


def payment(spark: SparkSession, sf_dir: str, as_of: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines as payments; ``lines`` as for rentals."""
    lines = order_lines(spark, sf_dir, as_of) if lines is None else lines
    return lines.select(
        F.col("line_id").alias("payment_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_suppkey").alias("staff_id"),
        F.col("line_id").alias("rental_id"),
        _disk().alias("inventory_id"),
        line_amount().alias("amount"),
        F.col("l_quantity").cast("int").alias("units"),
        F.col("first_date").alias("payment_date"),
        F.col("l_shipdate").alias("last_update"),
        _deleted(as_of).alias("deleted"),
    )


def staff(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    sold = line_states(
        spark, sf_dir, ["l_suppkey"], as_of, ["l_shipdate", "l_returnflag", "l_linestatus"]
    )
    supplier = table(spark, sf_dir, "supplier")
    return sold.join(supplier, sold.l_suppkey == supplier.s_suppkey).select(
        F.col("s_suppkey").alias("staff_id"),
        F.col("s_name").alias("first_name"),
        F.concat(F.lit("of "), F.col("s_name")).alias("last_name"),
        F.col("s_nationkey").alias("address_id"),
        F.concat(F.col("s_name"), F.lit("@example.org")).alias("email"),
        F.col("s_suppkey").alias("store_id"),
        (F.col("l_linestatus") == "O").alias("active"),
        F.col("s_name").alias("username"),
        F.col("l_returnflag").alias("password"),
        F.col("l_shipdate").alias("last_update"),
        _deleted(as_of).alias("deleted"),
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_suppkey").alias("manager_staff_id"),
        F.col("s_nationkey").alias("address_id"),
        ntz(BASE_TIME).alias("last_update"),
    )


def address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("address_id"),
        F.col("n_name").alias("address"),
        F.lit(None).cast("string").alias("address2"),
        F.concat(F.lit("district of "), F.col("n_name")).alias("district"),
        F.col("n_regionkey").alias("city_id"),
        F.lit(None).cast("string").alias("postal_code"),
        F.col("n_nationkey").cast("string").alias("phone"),
        ntz(BASE_TIME).alias("last_update"),
    )


def city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("city_id"),
        F.col("r_name").alias("city"),
        F.col("r_regionkey").alias("country_id"),
        ntz(BASE_TIME).alias("last_update"),
    )


def source_tables(spark: SparkSession, sf_dir: str, as_of: str) -> dict[str, DataFrame]:
    """All eight source tables as known just before ``as_of``.

    Loads read rentals and payments several times: the order lines behind them are
    written once.
    """
    lines = written_once(order_lines(spark, sf_dir, as_of))
    return {
        "film": film(spark, sf_dir, as_of),
        "inventory": inventory(spark, sf_dir, as_of),
        "rental": rental(spark, sf_dir, as_of, lines),
        "payment": payment(spark, sf_dir, as_of, lines),
        "staff": staff(spark, sf_dir, as_of),
        "store": store(spark, sf_dir),
        "address": address(spark, sf_dir),
        "city": city(spark, sf_dir),
    }


# Row-level views: every lineitem row is a payment, no reduction to states.


def payment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row as one payment; refused finished ones are deleted."""
    refused = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("rental_id"),
        F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("staff_id"),
        F.col("l_linenumber").alias("line"),
        line_amount().alias("amount"),
        F.col("l_shipdate").alias("payment_date"),
        F.when(refused, F.col("l_shipdate")).alias("deleted"),
    )


def rental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as one rental; open ones have no return date, pending are deleted."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("rental_id"),
        F.col("o_orderdate").alias("rental_date"),
        F.col("o_custkey").alias("customer_id"),
        F.when(
            F.col("o_orderstatus") != "P", F.col("o_orderdate") + F.expr("INTERVAL 7 DAYS")
        ).alias("return_date"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("deleted"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load log: event type as table name, time as load time."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("table_name"), F.col("ts").alias("update_dt")
    )


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed: user as key, time as stamp, ``error`` events as deletions."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id"),
        F.col("event_id"),
        F.col("event_type"),
        F.col("value").cast("decimal(12,2)").alias("value"),
        F.col("ts").alias("last_update"),
        F.when(F.col("event_type") == "error", F.col("ts")).alias("deleted"),
    )
