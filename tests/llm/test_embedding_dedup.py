import numpy as np
import pytest

from layerforge.llm import embedding_dedup as X

SCHEMA = "vec_id long, embedding array<float>, label int, links string, shard string"


def cloud(n, dim, groups, seed, spread=0.02):
    rnd = np.random.default_rng(seed)
    centers = rnd.normal(size=(groups, dim))
    return [centers[rnd.integers(groups)] + spread * rnd.normal(size=dim) if rnd.random() < 0.6 else rnd.normal(size=dim)
            for _ in range(n)]


def usable(v, label):
    return label is not None and v is not None and len(v) and all(
        x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, least=0.98):
    unit = {}
    for k, (i, v, label) in enumerate(rows):
        if i is not None and usable(v, label):
            x = np.array(v, np.float32).astype(np.float64)
            unit[k] = (label, len(v), x / np.sqrt((x * x).sum()))
    links = dict.fromkeys(range(len(rows)), 0)
    root = {i: i for i, *_ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k in unit:
        for j in unit:
            if j < k and unit[k][:2] == unit[j][:2] and unit[k][2] @ unit[j][2] >= least:
                links[k] += 1
                links[j] += 1
                a, b = find(rows[k][0]), find(rows[j][0])
                root[max(a, b)] = min(a, b)
    return sorted(((i, links[k], None if i is None else find(i), i is not None and find(i) == i)
                   for k, (i, *_) in enumerate(rows)), key=repr)


ODD = [(9001, None, 1), (9002, [], 1), (9003, [0.0] * 8, 1), (9004, [float("nan")] + [1.0] * 7, 1),
       (9005, [None] + [1.0] * 7, 1), (9006, [float("inf")] + [1.0] * 7, 1), (9007, [1.0] * 8, None),
       (9008, [1.0] * 8, 1), (9009, [2.0] * 8, 1), (9010, [-0.0] + [1.0] * 7, 2), (9011, [0.0] + [1.0] * 7, 2),
       (9012, [1.0] * 7, 1), (9013, [3e38] * 8, 1), (9014, [1e-30] * 8, 1), (None, [1.0] * 8, 1)]


@pytest.mark.parametrize("cluster,shard", [(250, 1000), (20, 40)])
def test_links_and_components_are_those_of_all_pairs(spark, monkeypatch, cluster, shard):
    monkeypatch.setattr(X, "CLUSTER", cluster)
    monkeypatch.setattr(X, "SHARD", shard)
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(cloud(260, 8, 6, 15))]
    rows += [(2000 + i, rows[0][1], 0) for i in range(30)]  # copies
    rows += ODD
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = X.near_duplicates(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    got, want = sorted((tuple(r) for r in got.collect()), key=repr), brute(rows)
    assert all(g[0] == w[0] and g[1] <= w[1] for g, w in zip(got, want))
    found, true = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found >= 0.98 * true
    if found == true:
        assert got == want


def test_search_on_one_graph_finds_dense_groups():
    x = np.array(cloud(500, 32, 5, 16, 0.01))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    hit = X.range_search(x, X.robust_graph(x), 0.98, X.BEAM)
    true = x @ x.T >= 0.98
    assert not (hit & ~(x @ x.T >= 0.98 - 1e-5)).any()
    assert (hit & true).sum() >= 0.99 * true.sum()


def test_every_node_can_be_reached():
    x = np.array(cloud(300, 16, 3, 17, 0.001))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph = X.robust_graph(x)
    seen, front = set(X.medoids(x).tolist()), X.medoids(x).tolist()
    while front:
        front = [int(j) for i in front for j in graph[i] if j >= 0 and j not in seen]
        seen.update(front)
    assert len(seen) == len(x)


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, "", "")], SCHEMA)
    assert [tuple(r) for r in X.near_duplicates(df).collect()] == [(1, 0, 1, True)]
    assert X.near_duplicates(df.limit(0)).collect() == []
    none = spark.createDataFrame([(1, None, 1, "", ""), (2, [0.0], 1, "", "")], SCHEMA)
    assert sorted(tuple(r) for r in X.near_duplicates(none).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def nodes_of(spark, vectors, copies):
    rows = [(0, i, [float(x) for x in v], c) for i, (v, c) in enumerate(zip(vectors, copies))]
    return spark.createDataFrame(rows, "grp long, id long, vec array<float>, copies long")


def test_copies_do_not_hide_a_missed_pair(spark):
    nodes = nodes_of(spark, [(1, 0, 0), (1, 0.01, 0), (0, 0, 1), (0, 0.01, 1)], [1000, 1000, 1, 1])
    found = spark.createDataFrame([(0, 1000, 1, 0), (1, 1000, 1, 0)], "id long, links long, pairs long, root long")
    assert X.recall(nodes, found, 0.98, 128) == 0.5
    every = found.union(spark.createDataFrame([(2, 1, 1, 2), (3, 1, 1, 2)], found.schema))
    assert X.recall(nodes, every, 0.98, 128) == 1.0


def test_rare_links_are_audited_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(X, "AUDIT_AT_ONCE", 300)
    rnd = np.random.default_rng(18)
    vectors = list(rnd.normal(size=(1500, 24)))
    vectors.append(vectors[0] + 1e-3)
    nodes = nodes_of(spark, vectors, [1] * len(vectors))
    none = spark.createDataFrame([], "id long, links long, pairs long, root long")
    assert X.recall(nodes, none, 0.98, 8) == 0.0
    both = spark.createDataFrame([(0, 1, 1, 0), (1500, 1, 1, 0)], none.schema)
    assert X.recall(nodes, both, 0.98, 8) == 1.0


def test_a_search_that_misses_the_target_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(X, "SEARCHES", 2)
    overlaps = []

    def search(nodes, overlap, beam, least):
        overlaps.append(overlap)
        return spark.createDataFrame([], "id long, links long, pairs long, root long")

    monkeypatch.setattr(X, "_search", search)
    df = spark.createDataFrame([(1, [1.0, 0.0], 1, "", ""), (2, [1.0, 0.01], 1, "", "")], SCHEMA)
    with pytest.raises(RuntimeError):
        X.near_duplicates(df).collect()
    assert overlaps == [2, 4]
