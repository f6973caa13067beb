import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerforge.llm import exact_dedup as X


def test_filter_knows_its_keys_and_few_others():
    rnd = np.random.default_rng(1)
    for n in (0, 1, 2, 10, 1000, 20_000):
        keys = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
        made = X.build_filter(keys)
        assert X.probe_filter(keys, *made).all()
        others = rnd.integers(0, 2**63, 50_000).astype(np.uint64)
        assert X.probe_filter(others, *made).mean() < 0.001
        assert n < 20_000 or made[3].nbytes < 3 * n  # about 9 cells of two bytes for 8 keys


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    classes = {}
    for i, text, *_ in rows:
        classes.setdefault(fold(text), []).append(i)
    out = []
    for i, text, *_ in rows:
        ids = classes[fold(text)]
        top = max((x for x in ids if x is not None), default=None)
        sha = hashlib.sha256(fold(text).encode()).hexdigest()
        out.append((i, top, len(ids), i is not None and i == top, sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keys_per_shard", [2, 50_000])
def test_classes_are_those_of_plain_grouping(docs, keys_per_shard):
    rnd = random.Random(2)
    texts = ["", None, " ", "A b", "a B", "é", "É", "x" * 200_000, "ab", "a\u0000b", "ſ", "K"]
    rows = [(i, rnd.choice(texts)) for i in range(300)] + [(1000 + i, f"only {i}") for i in range(50)]
    rows += [(7, "twice"), (7, "twice"), (None, "no id"), (None, "A b")]
    df = docs(rows)
    got = X.exact_dedup(df, batch=X.halves(df), keys_per_shard=keys_per_shard)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_three_batches_and_a_null_one(docs):
    rows = [(i, f"t{i % 5}") for i in range(40)]
    batch = F.when(F.col("doc_id") >= 5, (F.col("doc_id") / 14).cast("int"))
    got = X.exact_dedup(docs(rows), batch=batch)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected(rows)


def test_no_rows(docs):
    df = docs([(1, "a")]).limit(0)
    assert X.exact_dedup(df, batch=X.halves(df)).collect() == []
    assert X.without_copies(df).columns == df.columns


def test_the_stage_keeps_one_row_of_a_class(docs):
    rows = [(1, "A"), (2, "a"), (3, "b"), (3, "c"), (4, "c"), (5, None), (6, ""), (9, "z"), (9, "z"), (None, "a")]
    df = docs(rows)
    got = X.without_copies(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(
        [(2, "a"), (3, "b"), (4, "c"), (6, ""), (9, "z"), (None, "a")], key=repr)


def test_rows_without_an_id_stay_whatever_else_repeats(docs):
    rows = [(None, "a"), (None, "a"), (None, "b")]
    for more in ([], [(9, "z"), (9, "z")]):
        got = [(r.doc_id, r.text) for r in X.without_copies(docs(rows + more + [(1, "q")])).collect()]
        assert sorted(got, key=repr) == sorted([*rows, *more[:1], (1, "q")], key=repr)
