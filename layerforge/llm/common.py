"""Small helpers of the training-data operators."""

from __future__ import annotations

import gc
import string
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str, large: bool = False, codec: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs its running tasks, not the stages before.
    Spark drops the shuffle files of a finished plan when the driver collects its
    garbage; after a ``large`` one it is asked to.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path, compression=codec)
    if large:
        gc.collect()
        spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def with_fields(df: DataFrame, **added: str) -> T.StructType:
    """The schema of ``df`` with further fields, given as DDL types."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, T.DataType.fromDDL(k)) for n, k in added.items())])


ID_BITS = 23


def marked_ids(
    rows: DataFrame,
    ids: DataFrame,
    id_col: str = "id",
    then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """The rows whose id is in ``ids``, and some others; a screen before a join.

    ``then`` makes something of the rows that pass, in the same worker.

    The screen is a table of 2^ID_BITS bits of hashed ids (1 MB). Its size does not
    grow; more ids only let more other rows through.
    """
    part_bits = ID_BITS - 6

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << part_bits, bool)
        bits[pdf["cell"].to_numpy() >> 6] = True
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})

    def cell(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(1 << ID_BITS))

    name = ids.columns[0]
    parts = (
        ids.select(cell(name).alias("cell")).distinct().withColumn("part", F.col("cell") % 64)
        .groupBy("part").applyInPandas(mark, "part long, bits binary").collect()
    )
    packed = np.zeros((64, 1 << (part_bits - 3)), np.uint8)
    for r in parts:
        packed[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    screen = rows.sparkSession.sparkContext.broadcast(packed)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.unpackbits(screen.value, axis=1).astype(bool)
        for b in batches:
            c = b.column(b.num_columns - 1).to_numpy()
            b = b.select(range(b.num_columns - 1)).filter(pa.array(marks[c & 63, c >> 6]))
            yield b if then is None else then(b)

    return rows.withColumn("_cell", cell(id_col)).mapInArrow(keep, rows.schema if then is None else schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def lower_ascii(text: str | Column) -> Column:
    """A-Z to a-z; every other character stays."""
    c = F.col(text) if isinstance(text, str) else text
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def partitions_for(rows: int, per_partition: int) -> int:
    """How many groups of about ``per_partition`` rows hold ``rows`` rows."""
    return max(1, -(-rows // per_partition))
