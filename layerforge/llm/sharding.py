"""Byte-balanced shards by multiway Karmarkar-Karp differencing.

Rows with equal texts form one indivisible group. Groups are dealt to blocks by
digest; in each block the two partial partitions with the largest spread are
combined again and again, the heaviest part of one with the lightest of the
other, until one partition is left. The partitions of the blocks are combined
in the same way, level by level, so that no task sees more than ``fan_in``
groups or partitions.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerforge.llm.common import partitions_for, register, staged, table

FAN_IN = 4096


def differencing(parts: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Combine k-part partitions into one.

    ``parts[i]`` holds the k sums of item i. Returns the final sums in falling
    order and, for each item, the final part that each of its own parts went to.
    """
    k = len(parts[0])
    # a node: sums in falling order and, for each, a tree of (item, part) members
    heap = []
    for i, sums in enumerate(parts):
        order = sorted(range(k), key=lambda j: (-sums[j], j))
        node = [sums[j] for j in order]
        heap.append((node[-1] - node[0], i, node, [(i, j) for j in order]))
    heapq.heapify(heap)
    turn = len(parts)
    while len(heap) > 1:
        _, _, a, am = heapq.heappop(heap)
        _, _, b, bm = heapq.heappop(heap)
        sums = [a[j] + b[k - 1 - j] for j in range(k)]
        order = sorted(range(k), key=lambda j: (-sums[j], j))
        node = [sums[j] for j in order]
        heapq.heappush(heap, (node[-1] - node[0], turn, node, [[am[j], bm[k - 1 - j]] for j in order]))
        turn += 1
    _, _, sums, members = heap[0]
    went = [[0] * k for _ in parts]
    for part, tree in enumerate(members):
        stack = [tree]
        while stack:
            t = stack.pop()
            if isinstance(t, tuple):
                went[t[0]][t[1]] = part
            else:
                stack.extend(t)
    return sums, went


def _combined(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One level: nodes (node, parent, sums) to their placements and to the parents."""

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        sums, went = differencing([[int(x) for x in s] for s in pdf["sums"]])
        out = pd.DataFrame({"node": pdf["node"], "parent": pdf["parent"], "went": went})
        out["sums"] = [sums] + [None] * (len(out) - 1)
        return out[["node", "parent", "went", "sums"]]

    level = staged(
        nodes.groupBy("parent").applyInPandas(
            combine, "node long, parent long, went array<int>, sums array<long>"
        ),
        "level",
    )
    return level.select("node", "parent", "went"), level.where("sums IS NOT NULL").select(
        F.col("parent").alias("node"), "sums"
    )


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 8,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards of nearly equal bytes.

    Returns ``id_col``, size (UTF-8 bytes of the text plus 1), text_crc32, law
    ("bytes"), shard, slot (gapless from 0 in a shard) and grown_shard (null:
    this law makes no promise for another number of shards). Equal texts share
    a shard; null texts share one, of size 1 each and checksum 0 like the empty
    text. Null or repeated ids are placed like any other row. No rows give no rows.
    """
    text = F.col(text_col)
    rows = staged(
        docs.select(
            F.col(id_col).alias("_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.coalesce(F.sha2(text, 256), F.lit("")).alias("digest"),
        ),
        "sizes",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("weight"))
    n = groups.count()
    spark = docs.sparkSession
    if n == 0:
        return spark.createDataFrame(
            [], f"{id_col} long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"
        )
    blocks = partitions_for(n, fan_in)

    def first_level(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["weight", "digest"], ascending=[False, True])
        sums, went = differencing([[int(w)] + [0] * (shards - 1) for w in pdf["weight"]])
        out = pd.DataFrame({"digest": pdf["digest"], "block": pdf["block"], "part": [w[0] for w in went]})
        out["sums"] = [sums] + [None] * (len(out) - 1)
        return out

    # digests are spread evenly: one block holds about fan_in groups
    dealt = groups.select("digest", "weight", F.pmod(F.xxhash64("digest"), F.lit(blocks)).alias("block"))
    placed = staged(
        dealt.groupBy("block").applyInPandas(
            first_level, "digest string, block long, part int, sums array<long>"
        ),
        "blocks",
    )
    nodes = placed.where("sums IS NOT NULL").select(F.col("block").alias("node"), "sums")
    final = placed.select("digest", F.col("block").alias("node"), "part")
    count = blocks
    while count > 1:
        went, nodes = _combined(
            nodes.withColumn("parent", F.floor(F.col("node") / F.lit(fan_in)).cast("long"))
        )
        final = final.join(went, "node").select(
            "digest", F.col("parent").alias("node"), F.element_at("went", F.col("part") + 1).alias("part")
        )
        count = partitions_for(count, fan_in)
    return _with_slots(rows.join(final.select("digest", "part"), "digest"), id_col)


def _with_slots(rows: DataFrame, id_col: str) -> DataFrame:
    """Gapless numbers in each shard: a running number in each partition plus its offset."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for b in batches:
            shard = b.column("part").to_numpy()
            local = np.zeros(len(shard), np.int64)
            for s in np.unique(shard):
                mine = shard == s
                k = int(mine.sum())
                local[mine] = np.arange(k) + seen.get(s, 0)
                seen[s] = seen.get(s, 0) + k
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("_id", "size", "text_crc32", "part")),
                 pa.array(np.full(len(shard), piece, np.int64)), pa.array(local)],
                names=["_id", "size", "text_crc32", "part", "piece", "local"],
            )

    kind = dict(rows.dtypes)["_id"]
    numbered = staged(
        rows.select("_id", "size", "text_crc32", "part").mapInArrow(
            number, f"_id {kind}, size long, text_crc32 long, part int, piece long, local long"
        ),
        "slots",
    )
    # one row for each partition and shard
    tops = numbered.groupBy("part", "piece").agg((F.max("local") + 1).alias("n"))
    before = Window.partitionBy("part").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tops.select("part", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return numbered.join(offsets, ["part", "piece"]).select(
        F.col("_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("part").alias("shard"),
        (F.col("local") + F.col("offset")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register("op7_sharding")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), 8)
