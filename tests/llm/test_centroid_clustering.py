"""Centroid clustering against plain Python k-means on exact integers."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import types as T

from layerforge.llm import centroid_clustering as K

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("cluster", T.StringType()), T.StructField("v", T.StringType()),
])


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA).repartition(partitions)


def plain(rows, clusters=8, rounds=10):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            ints = [math.floor(1024 * float(np.float32(x))) for x in v]
            kept.append((i, [max(-K.LARGEST, min(K.LARGEST, x)) for x in ints]))

    def rank(row):
        return hashlib.sha256(f"3:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]

    centroids = [v for _, v in sorted(kept, key=rank)[:clusters]]

    def place(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(place(v)[1], []).append(v)
        for n, g in groups.items():
            centroids[n] = [sum(x) // len(g) for x in zip(*g, strict=True)]
    out, sums = [], {}
    for i, v in kept:
        d, n = place(v)
        sums[n] = sums.get(n, 0) + d
        out.append((i, n, d))
    return sorted(((i, n, d, sums[n], sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
                   for i, n, d in out), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def vectors(n, seed, spread=1.0):
    r = random.Random(seed)
    centers = [[r.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    return [(i, [c + r.gauss(0, 0.3) * spread for c in r.choice(centers)]) for i in range(n)]


def test_against_plain_python(spark):
    rows = vectors(300, 1)
    rows += [(1000 + i, [0.5] * 64) for i in range(40)]  # copies and ties
    rows += [(1000, [0.25] * 64), (1000, [0.25] * 64), (None, [0.1] * 64), (None, [0.1] * 64)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 65), (2004, [1.0] * 63 + [None]),
             (2005, [1.0] * 63 + [float("nan")]), (2006, [float("inf")] * 64), (2007, [0.0] * 64), (2008, [-0.0001] * 64),
             (2009, [1e30] + [0.0] * 63), (2010, [-3e5] * 64)]
    assert got(K.centroid_clusters(table(spark, rows))) == plain(rows)


def test_few_vectors_and_none(spark):
    rows = vectors(3, 2)
    assert got(K.centroid_clusters(table(spark, rows))) == plain(rows)
    out = K.centroid_clusters(table(spark, [(1, None)]))
    assert out.count() == 0 and out.columns == K.centroid_clusters(table(spark, rows)).columns


def test_empty_clusters_keep_their_centroid(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(20)]  # equal first centroids
    assert got(K.centroid_clusters(table(spark, rows))) == plain(rows)


def test_bounds_spare_distances():
    r = np.random.default_rng(4)
    centers = r.integers(-3000, 3000, (40, 64))
    v = centers[r.integers(0, 40, 5000)] + r.integers(-100, 100, (5000, 64))
    pivots = K.pick_pivots(v[:500], 12)
    d = np.stack([np.sqrt(((v - p) ** 2).sum(1)) for p in pivots], 1).astype(np.float32)
    best, distance, computed = K.nearest(v, d, centers, pivots)
    full = ((v[:, None] - centers[None]) ** 2).sum(2)
    assert (best == full.argmin(1)).all() and (distance == full.min(1)).all()
    assert computed < full.size / 8
