"""Source scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet table; with a schema no file footer is opened for inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str],
    key: str,
    bounds: tuple[int, int],
    partitions: int,
    properties: dict[str, str] | None = None,
    fetch_rows: int = 10_000,
) -> DataFrame:
    """Table of a remote database, read in key ranges in parallel.

    Filters and the column list are pushed into the remote query. ``bounds``
    only place the cuts; rows outside them are read by the outer ranges.
    """
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", key)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
        .option("fetchsize", fetch_rows)
        .option("preferTimestampNTZ", "true")
    )
    for name, value in (properties or {}).items():
        reader = reader.option(name, value)
    return reader.load().select(*columns)
