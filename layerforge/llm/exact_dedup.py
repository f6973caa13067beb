"""Exact deduplication of batches against immutable snapshots.

Every snapshot gets a static binary-fuse filter (three cells per key, 16-bit
fingerprints), built once in shards. The digests of a new batch are screened by
the filters of all earlier snapshots. Only positives and the duplicates inside
the batch itself go on to the exact buckets, which are keyed by the whole text,
so equality is decided byte by byte and a false positive costs work, not rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm.common import free_name, lower_ascii, partitions_for, register, staged, table

KEYS_PER_SHARD = 50_000  # keys of one filter
FILTER_SCHEMA = "shard long, seed long, segment long, segments long, cells binary"


# --- the filter --------------------------------------------------------------

def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser over key plus seed; wraps on purpose."""
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _cells(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """Three cells of each hash, in three neighbouring segments; shape (3, n)."""
    start = (h >> np.uint64(44)).astype(np.int64) % segments
    spots = [((h >> np.uint64(s)) & np.uint64(segment - 1)).astype(np.int64) for s in (0, 14, 28)]
    return np.stack([(start + i) * segment + spots[i] for i in range(3)])


def _fingerprints(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(seed, segment length, start segments, cells) over distinct uint64 keys.

    Keys are peeled in rounds: all cells that hold one remaining key give up
    that key at once. A seed whose graph does not empty is followed by the next.
    """
    n = max(1, len(keys))
    segment = 1 << max(2, min(13, int(np.log(n) / np.log(3.33) + 2.25)))
    spread = 1.25 if n > 5_000 else 1.6
    segments = max(1, int(np.ceil(n * spread / segment)))
    for seed in range(1, 10_000):
        h = _mixed(keys, seed)
        at = _cells(h, segment, segments)
        size = (segments + 2) * segment
        count = np.bincount(at.ravel(), minlength=size)
        # xor of the key numbers in a cell: the number itself where one is left
        number = np.zeros(size, np.int64)
        for row in at:
            np.bitwise_xor.at(number, row, np.arange(len(keys)))
        rounds, alive = [], len(keys)
        single = np.flatnonzero(count == 1)
        while len(single):
            key, first = np.unique(number[single], return_index=True)
            cell = single[first]
            rounds.append((key, cell))
            alive -= len(key)
            for row in at[:, key]:
                np.subtract.at(count, row, 1)
                np.bitwise_xor.at(number, row, key)
            touched = np.unique(at[:, key].ravel())
            single = touched[count[touched] == 1]
        if alive:
            continue
        cells, prints = np.zeros(size, np.uint16), _fingerprints(h)
        for key, cell in reversed(rounds):
            others = cells[at[0, key]] ^ cells[at[1, key]] ^ cells[at[2, key]] ^ cells[cell]
            cells[cell] = prints[key] ^ others
        return seed, segment, segments, cells
    raise RuntimeError("no seed empties the graph; are the keys distinct?")


def probe_filter(keys: np.ndarray, seed: int, segment: int, segments: int, cells: np.ndarray) -> np.ndarray:
    """True for every key of the filter and, by chance, for 1 in 65,536 others."""
    h = _mixed(keys, seed)
    at = _cells(h, segment, segments)
    return (cells[at[0]] ^ cells[at[1]] ^ cells[at[2]]) == _fingerprints(h)


def snapshot_filters(keys: DataFrame, shards: int) -> DataFrame:
    """One filter a shard over the distinct ``key`` values (long) of a snapshot."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, cells = build_filter(pdf["key"].to_numpy().astype(np.uint64))
        return pd.DataFrame([(int(pdf["shard"].iloc[0]), seed, segment, segments, cells.tobytes())],
                            columns=["shard", "seed", "segment", "segments", "cells"])

    distinct = keys.select("key").distinct().select(_shard(shards), "key")
    return distinct.groupBy("shard").applyInPandas(build, FILTER_SCHEMA)


def screen(keys: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The distinct ``key`` values that a filter may hold."""

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"key": pd.Series([], dtype="int64")})
        f = right.iloc[0]
        k = left["key"].to_numpy()
        hit = probe_filter(k.astype(np.uint64), int(f["seed"]), int(f["segment"]), int(f["segments"]),
                           np.frombuffer(f["cells"], np.uint16))
        return pd.DataFrame({"key": k[hit]})

    distinct = keys.select("key").distinct().select(_shard(shards), "key")
    return distinct.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(probe, "key long")


def _shard(shards: int) -> Column:
    return F.pmod(F.col("key"), F.lit(shards)).alias("shard")


# --- the batches -------------------------------------------------------------

def exact_dedup(
    docs: DataFrame,
    *,
    batch: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    keys_per_shard: int = KEYS_PER_SHARD,
) -> DataFrame:
    """Class of every row: the ids and texts of ``docs``, loaded in the order of ``batch``.

    ``batch`` gives the number of the load a row came with; all rows of smaller
    numbers are its snapshots. The number of batches is bounded by the caller.

    Returns ``id_col``, keep_id (largest id of the class), group_size, kept and
    text_sha256. Null text counts as empty, so null and empty rows form one
    class; rows that repeat an id are counted like others; a null id is never
    the largest unless the whole class has none (then keep_id is null and
    nothing is kept). Other columns are not looked at. No rows give no rows.
    """
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    read = docs.select(F.col(id_col).alias("_id"), norm.alias("norm"), batch.cast("int").alias("batch"))
    read = read.withColumn("key", F.xxhash64("norm"))
    digests = staged(
        read.select("_id", "batch", "key", F.sha2("norm", 256).alias("sha")), "digests"
    )

    counts = {r["batch"]: r["n"] for r in digests.groupBy("batch").agg(F.count("*").alias("n")).collect()}
    suspects = digests.groupBy("batch", "key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    earlier: list[tuple[DataFrame, int]] = []
    for number in sorted(counts, key=lambda b: (b is not None, b)):
        mine = digests.where(F.col("batch").eqNullSafe(F.lit(number)))
        for filters, shards in earlier:
            suspects = suspects.unionByName(screen(mine, filters, shards))
        shards = partitions_for(counts[number], keys_per_shard)
        if number != max(counts, key=lambda b: (b is not None, b)):
            earlier.append((staged(snapshot_filters(mine, shards), "filters"), shards))

    suspects = staged(suspects.distinct(), "suspects")
    # Exact buckets: whole texts are the keys. Copies meet within a map task first.
    classes = (
        read.join(suspects, "key", "left_semi")
        .groupBy("key", "norm")
        .agg(F.max("_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    )
    return digests.join(classes, "sha", "left").select(
        F.col("_id").alias(id_col),
        F.when(F.col("group_size").isNull(), F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(
            F.col("group_size").isNull() & F.col("_id").isNotNull() | (F.col("_id") == F.col("keep_id")),
            F.lit(False),
        ).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def halves(docs: DataFrame, id_col: str = "doc_id") -> Column:
    """Two loads: ids up to the middle of their range, and the rest."""
    low, high = docs.agg(F.min(id_col), F.max(id_col)).first()
    middle = 0 if low is None else (low + high) // 2
    return F.coalesce((F.col(id_col) > F.lit(middle)).cast("int"), F.lit(0))


def without_copies(docs: DataFrame) -> DataFrame:
    """The row with the largest id of every class of equal texts; rows without an id stay.

    Of equal rows with one id, one stays.
    """
    found = exact_dedup(docs, batch=halves(docs))
    sha = free_name(docs, "sha")
    keyed = docs.withColumn(sha, F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256))
    again = found.where("kept AND doc_id IS NOT NULL").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).where("n > 1")
    if not again.isEmpty():
        one = keyed.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", sha])
        keyed = one.unionByName(keyed.where("doc_id IS NULL"))
    gone = found.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id", F.col("text_sha256").alias(sha))
    return keyed.join(gone, ["doc_id", sha], "left_anti").select(*docs.columns)


@register(
    "op10_exact_dedup",
    """
    WITH d AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz') AS norm
        FROM documents
    ), g AS (
        SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
    FROM d JOIN g USING (norm)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents table: the upper half of the ids arrives after the lower one."""
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, batch=halves(docs))
