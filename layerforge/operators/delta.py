"""Load log, high-water marks, delta scans and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerforge.functions.dates import ORIGIN, ntz

Stamp = str | datetime | Column


# --- load log ---------------------------------------------------------------


def watermarks(log: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Last load time per table; tables asked for but never loaded get 1900-01-01."""
    known = log.groupBy("table_name").agg(F.max("update_dt").alias("update_dt"))
    if names is not None:
        known = names.select("table_name").distinct().join(known, "table_name", "left")
    return known.select(
        "table_name", F.coalesce(ntz(F.col("update_dt")), ntz(ORIGIN)).alias("update_dt")
    )


def read_watermark(log: DataFrame, table_name: str) -> datetime:
    """Last load time of one table as a driver value (one row)."""
    row = (
        log.filter(F.col("table_name") == table_name)
        .agg(F.coalesce(F.max("update_dt").cast("timestamp_ntz"), ntz(ORIGIN)))
        .first()
    )
    return row[0]


def target_watermark(target: DataFrame, column: str = "last_update") -> datetime:
    """Largest stamp already in the target, 1900-01-01 when it is empty."""
    return target.agg(F.coalesce(F.max(column).cast("timestamp_ntz"), ntz(ORIGIN))).first()[0]


def log_load(log: DataFrame, table_names: Sequence[str], load_ts: Stamp) -> DataFrame:
    """Log with one more row per table, all with the same load time."""
    names = F.explode(F.array(*[F.lit(n) for n in table_names]))
    added = (
        log.sparkSession.range(1)
        .select(names.alias("table_name"))
        .withColumn("update_dt", ntz(load_ts))
    )
    return log.select("table_name", "update_dt").unionByName(added)


def previous_load_times(log: DataFrame) -> DataFrame:
    """Second-newest load time per table; NULL after a single load.

    The newest ``lag(update_dt)`` in time order is the second-largest entry
    (a repeated newest time counts twice). Ranks up to two are kept before the
    shuffle, so a table with a third of the log never sits in one task.
    """
    newest_first = Window.partitionBy("table_name").orderBy(F.col("update_dt").desc())
    newest_two = log.withColumn("rn", F.row_number().over(newest_first)).filter("rn <= 2")
    return newest_two.groupBy("table_name").agg(
        F.max(F.when(F.col("rn") == 2, F.col("update_dt"))).alias("previous_dt")
    )


# --- delta scans -------------------------------------------------------------


def changed_since(
    wm: Stamp, columns: Sequence[str | Column], strict: bool = False
) -> Column:
    """Any stamp at (or, strictly, after) the mark; a NULL stamp never matches."""
    mark = ntz(wm)
    stamps = [F.col(c) if isinstance(c, str) else c for c in columns]
    tests = [(c > mark) if strict else (c >= mark) for c in stamps]
    return reduce(lambda a, b: a | b, tests)


def delta_scan(
    src: DataFrame,
    wm: Stamp,
    cols: Sequence[str] = ("last_update", "deleted"),
    strict: bool = False,
) -> DataFrame:
    """Rows updated or deleted since the mark; the filter reaches the scan."""
    return src.filter(changed_since(wm, cols, strict))


def delta_scan_joined(
    rows: DataFrame,
    parent: DataFrame,
    on: Sequence[str],
    wm: Stamp,
    take: Sequence[str],
    row_stamps: Sequence[str] = ("last_update", "deleted"),
    parent_stamps: Sequence[str] = ("last_update",),
) -> DataFrame:
    """Rows with ``take`` added from their parent, kept if either side changed.

    One OR over both sides could only run after a full join. The two disjoint
    parts below each push a filter into one scan and join a small side.
    """
    row_changed = F.coalesce(changed_since(wm, row_stamps), F.lit(False))
    parent_changed = changed_since(wm, parent_stamps)
    on = list(on)
    of_rows = rows.filter(row_changed).join(parent.select(*on, *take), on)
    of_parents = rows.filter(~row_changed).join(
        parent.filter(parent_changed).select(*on, *take), on
    )
    return of_rows.unionByName(of_parents)


def delta_from_target(
    src: DataFrame, target: DataFrame, column: str = "last_update", deleted: str | None = None
) -> DataFrame:
    """Rows newer than anything in the target; ``deleted`` also tests that stamp."""
    wm = target_watermark(target, column)
    return delta_scan(src, wm, [column, *([deleted] if deleted else [])], strict=True)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``.

    The rank filter is applied inside each map task before the shuffle, so a
    hot key sends at most one row per task.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(by_key))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


# --- upserts -----------------------------------------------------------------


def delete_insert(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the staged keys, plus the staged rows."""
    staged = delta.select(*keys).distinct()
    return target.join(staged, list(keys), "left_anti").unionByName(delta)


def upsert(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    deleted_col: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Overwrite by key; rows staged as deleted are removed and not re-added.

    ``keep`` names target columns the delta does not carry (a surrogate key):
    they survive an overwrite and are NULL on inserted rows.
    """
    keys, keep = list(keys), list(keep)
    live = delta
    if deleted_col is not None:
        live = delta.filter(F.col(deleted_col).isNull())
    live = live.select(*[c for c in target.columns if c not in keep])
    untouched = target.join(delta.select(*keys).distinct(), keys, "left_anti")
    if keep:
        kept = target.select(*keys, *keep).join(live.select(*keys).distinct(), keys, "left_semi")
        live = live.join(kept, keys, "left")
    return untouched.unionByName(live.select(*target.columns))


def append_rows(target: DataFrame, rows: DataFrame, load_ts: Stamp, stamp: str) -> DataFrame:
    """Target plus new rows stamped with the load time."""
    return target.unionByName(
        rows.withColumn(stamp, ntz(load_ts)).select(*target.columns)
    )


def newest_rows(df: DataFrame, stamp: str, *then: str) -> DataFrame:
    """Newest first; ties in the order of ``then``."""
    return df.orderBy(F.col(stamp).desc(), *[F.col(c) for c in then])


def full_refresh(src: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Projection that replaces a target as a whole."""
    return src.select(*columns)
