"""Tables on shared storage, found through the load log.

A load writes each table to a new directory and appends to the load log last.
Readers follow the log, so a load that dies half-way leaves the old state
visible and can run again under the same id.

Kinds of tables, by what a load has to write:

full      the whole table; readers take the newest load
append    new rows only; readers take all loads
versions  open rows and the rows this load closed; readers take the newest
          load and the closed rows of the earlier ones, back to the last load
          that emptied the table
keyed     staged rows only, the whole table now and then; for every key, readers
          take the rows of the newest load that has it
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerforge.functions.dates import ntz
from layerforge.operators.delta import Stamp
from layerforge.session import CODEC, count_rows_of_files, shared_folder

FULL, APPEND, VERSIONS, KEYED = "full", "append", "versions", "keyed"
# A keyed table is written whole again when the loads since hold this share of
# the rows of the last whole one, or are so many: bytes written stay in
# proportion to the rows staged.
FOLD_SHARE, FOLD_LOADS = 0.5, 32
# A table of so many loads is read by their names; of more, by a join with the log.
NAMED_LOADS = 256

# The schema is kept with the load: readers open no footer to infer it, and
# partition columns come back with their own type.
LOG_SCHEMA = (
    "table_name string, update_dt timestamp_ntz, load_id string, kind string, schema_json string"
)


@dataclass(frozen=True)
class Loaded:
    """A logged table: its newest load, kind and columns."""

    load_id: str
    kind: str
    schema: StructType
    active: str | None = None
    key: str | None = None
    rows: int | None = None  # of this load, for keyed tables
    whole: bool = False  # a keyed table's load that stands for all loads before it
    emptied: tuple[str, str] | None = None  # time and id of the load that emptied a table of versions

    def described(self) -> str:
        return json.dumps({
            "schema": self.schema.jsonValue(), "active": self.active, "key": self.key,
            "rows": self.rows, "whole": self.whole, "emptied": self.emptied,
        })

    @staticmethod
    def of(row: Row) -> Loaded:
        """From an entry of the load log."""
        d = json.loads(row["schema_json"])
        return Loaded(
            row["load_id"], row["kind"], StructType.fromJson(d["schema"]), d.get("active"),
            d.get("key"), d.get("rows"), d.get("whole", False),
            tuple(d["emptied"]) if d.get("emptied") else None,
        )


def scratch_store(spark: SparkSession) -> TableStore:
    """Store of its own in the shared folder, for one run; gone when the session's JVM ends."""
    return TableStore(spark, shared_folder(spark, "store"))


class TableStore:
    """Parquet tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        count_rows_of_files(spark)

    def path(self, name: str, part: str = "") -> str:
        return f"{self.root}/{name.replace('.', '/')}" + (f"/{part}" if part else "")

    # --- log ---------------------------------------------------------------------

    def log(self, besides: str | None = None) -> DataFrame:
        """All loads so far, without the load ``besides``."""
        try:
            rows = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/_load_log")
            rows = rows.select(*StructType.fromDDL(LOG_SCHEMA).names)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], LOG_SCHEMA)
        return rows if besides is None else rows.filter(F.col("load_id") != besides)

    def current(self, besides: str | None = None) -> dict[str, Loaded]:
        """State of every table, without the load ``besides`` (one row per table)."""
        newest = self.log(besides).groupBy("table_name").agg(
            F.max_by(F.struct("load_id", "kind", "schema_json"), "update_dt").alias("last")
        )
        return {r["table_name"]: Loaded.of(r["last"]) for r in newest.collect()}

    def loads(self, name: str, besides: str | None = None) -> list[Loaded]:
        """Loads of a keyed table from the last whole one on, oldest first (``FOLD_LOADS`` at most)."""
        rows = self.log(besides).filter(F.col("table_name") == name)
        whole = F.get_json_object("schema_json", "$.whole") == "true"
        since = rows.filter(whole).agg(F.max("update_dt")).first()[0]
        rows = rows if since is None else rows.filter(F.col("update_dt") >= F.lit(since))
        found = [Loaded.of(r) for r in rows.orderBy("update_dt", "load_id").collect()]
        starts = [i for i, t in enumerate(found) if t.whole]
        return found[starts[-1]:] if starts else found

    def commit(self, tables: dict[str, Loaded], load_ts: Stamp) -> None:
        """Make the tables of a load visible: one new file under the log."""
        rows = [(n, t.load_id, t.kind, t.described()) for n, t in tables.items()]
        named = self.spark.createDataFrame(
            rows, "table_name string, load_id string, kind string, schema_json string"
        ).withColumn("update_dt", ntz(load_ts))
        log = named.select("table_name", "update_dt", "load_id", "kind", "schema_json")
        log.coalesce(1).write.parquet(f"{self.root}/_load_log/entry={uuid.uuid4().hex}")

    # --- tables ------------------------------------------------------------------

    def write(
        self, name: str, df: DataFrame, load_id: str, partition_by: tuple[str, ...] = ()
    ) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            *partition_by
        ).parquet(self.path(name, f"load={load_id}"), compression=CODEC)

    def write_keyed(self, name: str, df: DataFrame, load_id: str, whole: bool) -> int:
        """Staged rows of a load, or the whole table as it leaves it; returns their number (from the footers)."""
        path = self.path(name, f"{'whole' if whole else 'load'}={load_id}")
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path, compression=CODEC)
        return self.spark.read.schema(df.schema).parquet(path).count()

    def open(self, name: str, table: Loaded, besides: str | None = None) -> DataFrame:
        """Rows of a logged table; of a load not logged yet, its own rows count too.

        Tables of several loads are read as one directory, in one scan that names
        the logged loads: other loads' files are pruned, and plans stay small. Many
        loads are joined on the partition column instead.
        """
        reader, columns = self.spark.read, table.schema.names
        if table.kind == KEYED:
            return self._newest_by_key(name, table, besides)
        if table.kind == FULL:
            return reader.schema(table.schema).parquet(
                self.path(name, f"load={table.load_id}")
            ).select(*columns)
        rows = reader.schema(StructType([*table.schema.fields]).add("load", "string")).parquet(
            self.path(name)
        )
        logged = self.log(besides).filter(F.col("table_name") == name)
        if table.emptied is not None:
            at, load_id = table.emptied
            logged = logged.filter((F.col("update_dt") > ntz(at)) | (F.col("load_id") == load_id))
        logged = logged.select(F.col("load_id").alias("load"))
        ids = [r["load"] for r in logged.limit(NAMED_LOADS + 1).collect()]
        if len(ids) <= NAMED_LOADS:
            # Also a directory name: earlier loads' open rows are not read.
            closed = ~F.col(table.active) if table.kind == VERSIONS else F.lit(True)
            others = sorted({i for i in ids if i != table.load_id})
            read = F.col("load") == table.load_id
            read = read | (F.col("load").isin(others) & closed) if others else read
            return rows.filter(F.col("load").isNotNull() & read).select(*columns)
        earlier = rows.filter(F.col("load") != table.load_id).join(logged, "load", "left_semi")
        if table.kind == VERSIONS:
            # Also a directory name: earlier loads' open rows are not read.
            earlier = earlier.filter(~F.col(table.active))
        mine = rows.filter(F.col("load") == table.load_id)
        return mine.unionByName(earlier).select(*columns)

    def _newest_by_key(self, name: str, table: Loaded, besides: str | None) -> DataFrame:
        """The whole load without the keys staged since, and the newest load's rows of those.

        Only the rows staged since are ranked, and by map tasks before the
        shuffle; their keys are looked up from the whole load's side, so it is
        scanned without a shuffle while they are few.
        """
        loads = [t for t in self.loads(name, besides) if t.load_id != table.load_id]
        loads = [table] if table.whole else [*loads, table]
        files = self.spark.read.schema(table.schema)
        parts = [files.parquet(self.path(name, f"{'whole' if t.whole else 'load'}={t.load_id}")) for t in loads]
        if len(parts) == 1:
            return parts[0]
        since = [p.withColumn("_load", F.lit(i)) for i, p in enumerate(parts) if i]
        by_key = Window.partitionBy(table.key).orderBy(F.col("_load").desc())
        staged = reduce(DataFrame.unionByName, since)
        # Equal ranks stay: a load may stage several rows of a key.
        newest = staged.withColumn("_rank", F.rank().over(by_key)).filter("_rank = 1").drop("_rank", "_load")
        keys = staged.select(table.key).distinct()
        return parts[0].join(keys, table.key, "left_anti").unionByName(newest)

    def read(self, name: str, current: dict[str, Loaded] | None = None) -> DataFrame | None:
        """Newest committed state of a table, None before its first load."""
        current = self.current() if current is None else current
        return self.open(name, current[name]) if name in current else None
