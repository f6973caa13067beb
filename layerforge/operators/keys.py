"""Dense surrogate keys and key translation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerforge.session import cut_lineage

_POSITION_BITS = (1 << 33) - 1  # row position inside a partition, as Spark numbers rows


def _by_name(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column], name: str, start: int | Column = 0
) -> DataFrame:
    """``start + 1, start + 2, ...`` in the order of ``order_by``, in parallel.

    Rows are range-partitioned and sorted, then written to the checkpoint
    folder: range bounds are sampled, so a recomputed plan could cut elsewhere.
    The offset of a partition is the number of rows before it; that table has
    one row per partition.
    """
    order = _by_name(order_by)
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = placed.select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("_pos"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    first = start if isinstance(start, Column) else F.lit(start)
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (first + F.col("_before") + F.col("_pos") + 1).cast("long").alias(name)
    )


def max_key(table: DataFrame, column: str) -> int:
    """Largest key in use, 0 for an empty table (one row to the driver)."""
    return table.agg(F.coalesce(F.max(column), F.lit(0))).first()[0]


def new_keys(src: DataFrame, key_table: DataFrame, nk: Sequence[str]) -> DataFrame:
    """Distinct natural keys of the source that have no surrogate yet."""
    return src.select(*nk).distinct().join(key_table.select(*nk), list(nk), "left_anti")


def added_keys(
    src: DataFrame, key_table: DataFrame, nk: str | Sequence[str], sk: str = "sk"
) -> DataFrame:
    """Key rows for unseen natural keys, numbered on in key order."""
    nk = [nk] if isinstance(nk, str) else list(nk)
    unseen = new_keys(src, key_table, nk)
    added = number_rows(unseen, nk, sk, start=max_key(key_table, sk))
    return added.select(*key_table.columns)


def assign_keys(
    src: DataFrame, key_table: DataFrame, nk: str | Sequence[str], sk: str = "sk"
) -> DataFrame:
    """Key table with surrogates added for unseen natural keys."""
    return key_table.unionByName(added_keys(src, key_table, nk, sk))


def fill_keys(
    df: DataFrame, sk: str, order_by: Sequence[str | Column], known: DataFrame | None = None
) -> DataFrame:
    """Give rows without a surrogate the next numbers; others keep theirs.

    ``known`` is a table already holding every number in use (the target before
    a merge): its maximum is read from the files instead of from the new plan.
    """
    start = max_key(df if known is None else known, sk)
    added = number_rows(df.filter(F.col(sk).isNull()).drop(sk), order_by, sk, start)
    return df.filter(F.col(sk).isNotNull()).unionByName(added.select(*df.columns))


def translate_keys(
    df: DataFrame,
    mapping: Mapping[str, DataFrame],
    nk: str = "nk",
    sk: str = "sk",
    how: str = "inner",
) -> DataFrame:
    """Replace natural keys by surrogates, one join per mapped column.

    Rows without a match drop under the default inner join. Columns not in the
    mapping keep their natural keys.
    """
    out = df
    for column, key_table in mapping.items():
        lookup = key_table.select(F.col(nk).alias(column), F.col(sk).alias("_sk"))
        out = out.join(lookup, column, how).drop(column).withColumnRenamed("_sk", column)
    return out.select(*df.columns)


def count_untranslated(df: DataFrame, mapping: Mapping[str, DataFrame], nk: str = "nk") -> DataFrame:
    """Rows per mapped column whose natural key has no surrogate.

    Values are counted before the join, so a hot unmatched key is one row.
    """
    counts = None
    for column, key_table in mapping.items():
        lookup = key_table.select(F.col(nk).alias(column))
        missing = (
            df.groupBy(column)
            .agg(F.count("*").alias("n"))
            .join(lookup, column, "left_anti")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("dropped_rows"))
            .select(F.lit(column).alias("key_column"), "dropped_rows")
        )
        counts = missing if counts is None else counts.unionByName(missing)
    return counts
