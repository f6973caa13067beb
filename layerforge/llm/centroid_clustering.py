"""Exact integer k-means with a pivot table that spares distances.

The distances of every vector to a few fixed pivots are computed once and written
beside it. In each round the centroids' distances to the same pivots give a lower
bound of every vector's distance to every centroid (the largest difference over
the pivots). Centroids are tried in the order of their bounds; one whose bound
lies above the best distance found so far cannot win and is never computed. The
others get exact integer distances, so the result does not depend on the pivots.

A round is one scan: tasks sum up their vectors by cluster and send one row per
cluster and component. Only centroids come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerforge.llm.common import register, staged, table

DIMENSIONS = 64
SCALE = 1024
# Components are held to this size on either side (131,072 before scaling), so
# that squared distances fit in 64 bits.
LARGEST = 1 << 27
PIVOTS = 12
PIVOT_SAMPLE = 1024  # vectors the pivots are picked from
BLOCK = 8192  # vectors a task handles at a time
MARGIN = 1e-6  # stored distances are 32-bit floats; bounds are lowered by this share


def integers(vec: Column, dimensions: int = DIMENSIONS) -> Column:
    """Components as integers floor(SCALE * x); null unless there are ``dimensions`` finite ones."""
    fits = (F.size(vec) == dimensions) & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    scaled = F.transform(vec, lambda x: F.least(F.greatest(
        F.floor(x.cast("double") * SCALE), F.lit(-LARGEST)), F.lit(LARGEST)).cast("int"))
    return F.when(fits, scaled)


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def pick_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those before it."""
    chosen = [0]
    far = _squared(sample, sample[0])
    while len(chosen) < min(pivots, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _squared(sample, sample[chosen[-1]]))
    return sample[chosen]


def nearest(
    vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(number of the nearest centroid, its squared distance, distances computed); ties take the smaller number."""
    rows, k = np.arange(len(vectors)), len(centroids)
    bound = np.zeros((len(vectors), k))
    for p, pivot in enumerate(pivots):
        own = to_pivots[:, p, None].astype(np.float64)
        of_centroids = np.sqrt(_squared(centroids, pivot).astype(np.float64))
        np.maximum(bound, np.abs(own - of_centroids) - MARGIN * (own + of_centroids), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    best = order[:, 0].copy()
    distance = _squared(vectors, centroids[best])
    computed = len(vectors)
    for turn in range(1, k):
        c = order[rows, turn]
        open_ = bound[rows, c] <= np.sqrt(distance[rows].astype(np.float64)) * (1 + 1e-12)
        rows, c = rows[open_], c[open_]  # bounds only grow from here on
        if not len(rows):
            break
        d = _squared(vectors[rows], centroids[c])
        computed += len(rows)
        better = (d < distance[rows]) | ((d == distance[rows]) & (c < best[rows]))
        best[rows[better]], distance[rows[better]] = c[better], d[better]
    return best, distance, computed


class KMeans:
    """Rounds over a table of (vec_id, v, to_pivots) with given first centroids."""

    def __init__(self, rows: DataFrame, pivots: np.ndarray, centroids: Sequence[Sequence[int]]):
        self.rows, self.pivots = rows, pivots
        self.centroids = [list(map(int, c)) for c in centroids]

    def _assigned(self, batch: pa.RecordBatch, v: int, d: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, int]]:
        centroids, pivots = np.array(self.centroids, np.int64), self.pivots
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            vectors = _matrix(part.column(v), centroids.shape[1], np.int64)
            to_pivots = _matrix(part.column(d), len(pivots), np.float32)
            yield at, vectors, *nearest(vectors, to_pivots, centroids, pivots)

    def round(self) -> int:
        """Moves every non-empty centroid to the floor of its mean; returns distances computed."""
        me, k, width = self._small(), len(self.centroids), len(self.centroids[0])

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, count, done = np.zeros((k, width), np.int64), np.zeros(k, np.int64), 0
            for b in batches:
                for _, vectors, best, _, computed in me._assigned(b, 0, 1):
                    done += computed
                    count += np.bincount(best, minlength=k)
                    for c in range(k):
                        total[c] += vectors[best == c].sum(axis=0)
            yield pa.RecordBatch.from_pydict({
                "cluster": np.append(np.repeat(np.arange(k), width + 1), -1),
                "place": np.append(np.tile(np.arange(width + 1), k), 0),
                "total": np.append(np.hstack([total, count[:, None]]).ravel(), done),
            })

        got = (
            self.rows.select("v", "to_pivots").mapInArrow(sums, "cluster long, place long, total long")
            .groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        )
        whole = {(r["cluster"], r["place"]): int(r["total"]) for r in got}
        for c in range(k):
            n = whole.get((c, width), 0)
            if n:
                self.centroids[c] = [whole[c, i] // n for i in range(width)]
        return whole.get((-1, 0), 0)

    def assigned(self) -> DataFrame:
        """vec_id, cluster and squared distance of every vector."""
        me = self._small()

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at, _, best, distance, _ in me._assigned(b, 1, 2):
                    part = b.column(0).slice(at, len(best))
                    yield pa.RecordBatch.from_arrays(
                        [part, pa.array(best.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
                    )

        kept = self.rows.select("vec_id", "v", "to_pivots")
        schema = T.StructType([kept.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
        return kept.mapInArrow(place, schema)

    def _small(self) -> KMeans:
        """What a task needs: centroids and pivots, without the table."""
        other = KMeans.__new__(KMeans)
        other.rows, other.pivots, other.centroids = None, self.pivots, [list(c) for c in self.centroids]
        return other


def centroid_clusters(
    embeddings: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", dimensions: int = DIMENSIONS,
    clusters: int = 8, rounds: int = 10, seed: int = 3, pivots: int = PIVOTS,
) -> DataFrame:
    """One row per vector that has ``dimensions`` finite components; the others are left out.

    The first centroids are the vectors with the smallest SHA-256 of
    ``<seed>:<id>`` (no id: nothing after the colon; equal hashes in the order of
    their components); fewer vectors than ``clusters`` make fewer centroids.
    Returns ``id_col``, cluster, distance (squared), cluster_inertia, inertia and
    centroid_sha256. Rows that repeat an id are vectors of their own. Components
    beyond 131,072 on either side count as that. No rows give no rows; further
    columns are not looked at.
    """
    rows = embeddings.select(F.col(id_col).alias("vec_id"), integers(F.col(vec_col), dimensions).alias("v")).where("v IS NOT NULL")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    # Bounded: the first centroids and the vectors that pivots are picked from.
    first = [r["v"] for r in rows.orderBy(rank, "v").select("v").limit(max(clusters, PIVOT_SAMPLE)).collect()]
    chosen = pick_pivots(np.array(first, np.int64), pivots) if first else np.zeros((0, dimensions), np.int64)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column(1), dimensions, np.int64)
            d = np.stack([np.sqrt(_squared(v, p).astype(np.float64)) for p in chosen], axis=1) if len(chosen) else np.zeros((len(v), 0))
            lists = pa.ListArray.from_arrays(
                np.arange(len(v) + 1, dtype=np.int32) * d.shape[1], pa.array(d.astype(np.float32).ravel())
            )
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, "to_pivots"])

    with_pivots = T.StructType([*rows.schema.fields, T.StructField("to_pivots", T.ArrayType(T.FloatType()))])
    rows = staged(rows.mapInArrow(measure, with_pivots), "vectors")
    final = "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    if not first:
        empty = [F.lit(None).cast(t).alias(n) for n, t in zip(final[1:], ("int", "long", "long", "long", "string"), strict=True)]
        return rows.select(F.col("vec_id").alias(id_col), *empty)
    model = KMeans(rows, chosen, first[:clusters])
    for _ in range(rounds):
        model.round()
    placed = staged(model.assigned(), "assigned")
    sums = {
        r["cluster"]: int(r["total"])
        for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    }
    most, whole = 2**63 - 1, sum(sums.values())
    # One row per centroid.
    described = rows.sparkSession.createDataFrame([
        (c, min(sums.get(c, 0), most), min(whole, most), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
        for c, v in enumerate(model.centroids)
    ], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(described), "cluster").select(F.col("vec_id").alias(id_col), *final[1:])


# --- query ---------------------------------------------------------------------


def _sql(clusters: int = 8, rounds: int = 10) -> str:
    """The rounds written out, with every distance computed."""
    inside = (f"len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0")
    steps = [f"""rows AS (SELECT row_number() OVER () AS r, vec_id,
        list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE {inside})""",
             f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INT) AS c, v AS m FROM (
        SELECT v, sha256('3:' || vec_id) AS h FROM rows) ORDER BY h, v LIMIT {clusters})"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, d * {clusters} + c) AS c, min(d) AS d FROM (
        SELECT r, c, list_sum(list_transform(range(1, {DIMENSIONS + 1}),
            lambda i: (v[i] - m[i]) * (v[i] - m[i]))) AS d FROM rows, c{i}) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(n.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
        SELECT c, list(f ORDER BY i) AS m FROM (
            SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS f FROM (
                SELECT c, i, sum(v[i]) AS s, count(*) AS n
                FROM a{i} JOIN rows USING (r), range(1, {DIMENSIONS + 1}) AS g(i) GROUP BY c, i)) GROUP BY c) n
        ON n.c = c{i}.c)""")
    return "WITH " + ",\n".join(steps) + f"""
    SELECT vec_id, a.c AS cluster, CAST(d AS BIGINT) AS distance,
        CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(m, ',')) AS centroid_sha256
    FROM a{rounds} a JOIN rows USING (r) JOIN c{rounds} ON c{rounds}.c = a.c"""


@register("op12_centroid_clustering", _sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(table(spark, sf_dir, "embeddings"))
