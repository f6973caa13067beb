"""Layered load: staging, ods, ref, integ, dds, report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerforge.functions.dates import MONTHS_EN
from layerforge.operators.calendar import calendar_small
from layerforge.operators.delta import Stamp, delta_from_target, delta_scan
from layerforge.operators.history import Rule, Validity, empty_history, scd2_merge
from layerforge.operators.keys import added_keys, translate_keys
from layerforge.plans.reports import sales_by_date, sales_by_film
from layerforge.plans.sinks import StoreSink
from layerforge.plans.steps import side_by_side
from layerforge.sources.store import TableStore

# Natural key of each table.
KEY = {
    "film": "film_id",
    "inventory": "inventory_id",
    "rental": "rental_id",
    "address": "address_id",
    "city": "city_id",
    "staff": "staff_id",
    "store": "store_id",
    "payment": "payment_id",
}
DELTA_TABLES = ("rental", "payment")
DIMENSIONS = ("film", "inventory", "address", "city", "staff", "store")

# Columns replaced by surrogates in integ, and whose key table they use. The
# columns not listed (manager, customer, language, country) stay natural.
TRANSLATED = {
    "film": {"film_id": "film"},
    "inventory": {"inventory_id": "inventory", "film_id": "film", "store_id": "store"},
    "rental": {"rental_id": "rental", "inventory_id": "inventory", "staff_id": "staff"},
    "address": {"address_id": "address", "city_id": "city"},
    "city": {"city_id": "city"},
    "staff": {"staff_id": "staff", "address_id": "address", "store_id": "store"},
    "store": {"store_id": "store", "address_id": "address"},
    "payment": {"payment_id": "payment", "staff_id": "staff", "rental_id": "rental"},
}

DDS_VALIDITY = Validity("date_effective_from", "date_effective_to", "is_active")
STAMPS = ("last_update", "deleted")


def load(
    source: dict[str, DataFrame],
    sink: StoreSink,
    load_ts: Stamp,
    calendar_start: date | str,
    calendar_days: int,
    months=MONTHS_EN,
    whole_row_hash: bool = False,
) -> dict[str, DataFrame]:
    """One full load of all layers with one load time.

    The two delta tables are read from their marks in the load log on.
    ``whole_row_hash`` also counts a bump of ``last_update`` as a change.
    """
    def to_staging(name: str) -> DataFrame:
        df = source[name]
        rows = delta_scan(df, sink.mark(f"staging.{name}")) if name in DELTA_TABLES else df
        return sink.put(f"staging.{name}", rows)

    staging = side_by_side(source, to_staging)

    def to_ods(name: str) -> DataFrame:
        target = f"ods.{name}"
        if name in DELTA_TABLES:
            return sink.upsert(target, staging[name], KEY[name])
        return sink.put(target, staging[name])

    ods = side_by_side(source, to_ods)

    def to_ref(name: str) -> DataFrame:
        known = sink.get(f"ref.{name}")
        # A key not staged now was numbered when it was staged, so the delta
        # tables need only their staged rows looked up.
        rows = staging[name]
        keyed = rows.select(F.col(KEY[name]).cast("long").alias("nk"))
        if known is None:
            known = keyed.limit(0).select(F.lit(0).cast("long").alias("sk"), "nk")
        return sink.append(f"ref.{name}", added_keys(keyed, known, "nk"))

    ref = side_by_side(source, to_ref)

    def to_integ(name: str) -> DataFrame:
        mapping = {column: ref[table] for column, table in TRANSLATED[name].items()}
        rows = ods[name].withColumns({c: F.col(c).cast("long") for c in mapping})
        target = f"integ.{name}"
        if name not in DELTA_TABLES:
            return sink.put(target, translate_keys(rows, mapping))
        before = sink.get(target)
        fresh = rows if before is None else delta_from_target(rows, before)
        return sink.upsert(target, translate_keys(fresh, mapping), KEY[name])

    integ = side_by_side(source, to_integ)

    def to_dds(name: str) -> DataFrame:
        target, rows = f"dds.{name}", integ[name]
        before = sink.get(target)
        if name not in DELTA_TABLES:
            changes = _versioned(before, rows, name, load_ts, whole_row_hash)
            return sink.versions(target, changes, DDS_VALIDITY.active)
        fresh = rows if before is None else delta_from_target(rows, before)
        return sink.upsert(target, fresh, KEY[name])

    dds = side_by_side(source, to_dds)

    spark = next(iter(source.values())).sparkSession
    calendar = calendar_small(spark, calendar_start, calendar_days, months)
    marts = {
        "sales_by_date": sales_by_date(dds["payment"], calendar),
        "sales_by_film": sales_by_film(
            dds["payment"], dds["rental"], dds["inventory"], dds["film"]
        ),
    }
    report = side_by_side(marts, lambda name: sink.put(f"report.{name}", marts[name]))
    sink.commit()
    layers = {"staging": staging, "ods": ods, "ref": ref, "integ": integ, "dds": dds,
              "report": report}
    return {f"{layer}.{name}": df for layer, tables in layers.items() for name, df in tables.items()}


def _versioned(
    before: DataFrame | None, rows: DataFrame, name: str, load_ts: Stamp, whole_row_hash: bool
) -> DataFrame:
    business = [c for c in rows.columns if c not in STAMPS]
    rule = Rule(
        change="hash",
        tracked=[c for c in rows.columns if whole_row_hash or c not in STAMPS],
        deleted="deleted" if "deleted" in rows.columns else None,
        hash_column="hash",
        validity=DDS_VALIDITY,
    )
    if before is None:
        stamps = [c for c in STAMPS if c in rows.columns]
        before = empty_history(rows, DDS_VALIDITY, drop=stamps).withColumn("hash", F.lit(""))
        before = before.select(*business, *DDS_VALIDITY.columns, "hash")
    return scd2_merge(
        before, rows, [KEY[name]], rule, load_ts, keep_closed=False
    )


def sales_by_film_report(store: TableStore) -> DataFrame:
    """Title and amount from the committed film mart."""
    rows = store.read("report.sales_by_film")
    return rows.select(F.col("sales_film_title").alias("title"), "amount")


def sales_by_date_report(store: TableStore) -> DataFrame:
    """Day and amount from the committed date mart."""
    rows = store.read("report.sales_by_date")
    return rows.select(F.col("sales_date_title").alias("date_title"), "amount")
