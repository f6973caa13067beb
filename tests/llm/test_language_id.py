import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerforge.llm import language_id as X

SYLLABLES = {"xx": ["ba", "ko", "ti", "mu"], "yy": ["ße", "ün", "sch", "ött"], "zz": ["кор", "ня", "ти", "во"]}


def text(lang, n, seed):
    rnd = random.Random(f"{lang}{seed}")
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n)).capitalize() + "."


def test_presence_counts_each_gram_once_whatever_the_slices(monkeypatch):
    long = text("yy", 3000, 1)
    whole = X.presence([long, long + long, "", "a"])
    assert (whole[0] <= whole[1]).all() and not whole[2].any() and whole[3].sum() == 1
    monkeypatch.setattr(X, "_SLICE", 100)
    assert (X.presence([long])[0] == whole[0]).all()


def test_batched_scores_are_kernel_scores():
    """One matrix product gives what kernel values times coefficients give."""
    texts = [text(l, 30, s) for l in SYLLABLES for s in range(8)]
    labels = [l for l in SYLLABLES for _ in range(8)]
    rows = X.presence(texts)
    model = X.fit(rows, labels, landmarks=24)
    x = rows / np.sqrt(rows.sum(axis=1, keepdims=True))
    kernel = x @ x.T
    y = np.where(np.array(labels)[:, None] == np.array(model.languages), 1.0, -1.0)
    direct = kernel @ np.linalg.solve(kernel @ kernel / 8 + (X.RIDGE * kernel + 1e-8 * np.eye(24)), kernel @ y / 8)
    assert np.allclose(x @ model.weights, direct, atol=1e-3)
    assert X.predict(model, texts)[0] == labels


@pytest.fixture
def rows():
    out = [(i, text(l, random.Random(i).randint(1, 80), i), l) for i, l in enumerate(list(SYLLABLES) * 60)]
    return [*out, (900, None, "xx"), (901, "", "yy"), (902, "123 !? ²", "zz"), (903, text("zz", 100_000, 3), None),
            (904, text("xx", 40, 4), None), (905, "twice ba", "xx"), (905, "twice ba", "xx"), (None, text("yy", 20, 5), "yy")]


def test_held_out_accuracy_and_unknowns(docs, rows):
    df = docs(rows)
    found = X.identify(df, X.train(df, ~X.held_out()), lang_out="guess", score_out="sure").withColumn("out", X.held_out())
    got = found.collect()
    assert len(got) == len(rows) and set(df.columns) < set(found.columns)
    fold = [r for r in got if r.out and r.lang and r.text and len(r.text) > 12]
    assert len(fold) > 20 and sum(r.guess == r.lang for r in fold) >= 0.97 * len(fold)
    for r in got:
        assert (r.guess == "und") == (r.text is None or not any(c.isalpha() for c in r.text))
        assert r.guess in ("und", *SYLLABLES) and 0.0 <= r.sure <= 1.0
    assert {r.doc_id: r.guess for r in got}[903] == "zz"


def test_labels_sources_and_ids_are_not_looked_at(docs, rows):
    df = docs(rows)
    model = X.train(df, ~X.held_out())
    one = {r.text: (r.lang_pred, r.score) for r in X.identify(df, model).collect()}
    other = df.withColumns({"lang": F.lit("xx"), "source": F.lit("?"), "doc_id": F.lit(1)})
    assert {r.text: (r.lang_pred, r.score) for r in X.identify(other, model).collect()} == one


def test_the_held_out_fold_never_trains(docs, rows):
    df = docs(rows)
    wrong = df.withColumn("lang", F.when(X.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = X.train(df, ~X.held_out()), X.train(wrong, ~X.held_out())
    assert a.languages == b.languages and (a.weights == b.weights).all()


def test_nothing_to_learn_from(docs):
    df = docs([(1, "abc", None), (2, None, "xx")])
    model = X.train(df, ~X.held_out())
    assert model.languages == []
    assert {r.lang_pred for r in X.identify(df, model).collect()} == {"und"}
    assert X.accepted(df).collect() == [] and X.accepted(df.limit(0)).columns == df.columns


def test_the_stage_drops_only_the_unknown(docs, rows):
    df = docs(rows)
    got = X.accepted(df)
    assert got.columns == df.columns
    gone = {900, 901, 902}
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted((i for i, *_ in rows if i not in gone), key=repr)


def test_the_stage_drops_unlearned_languages_and_gibberish(docs, rows):
    rnd = random.Random(7)
    strange = [
        " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 9))) for _ in range(60))
        for letters in ("αβγδεζηθικλμνξοπρστυφχψω", "日月火水木金土山川田人口", "bcdfghjklmnpqrtvwxz") for _ in range(4)
    ]
    df = docs([*rows, *((2000 + i, t, "xx") for i, t in enumerate(strange))])
    left = {r.doc_id for r in X.accepted(df.withColumn("lang", F.when(F.col("doc_id") < 2000, F.col("lang")))).collect()}
    assert not [i for i in left if i is not None and i >= 2000]
    assert {i for i, t, _ in rows if t and X.has_letter(t)} <= left


def test_short_texts_are_judged_too(docs, rows):
    """A few words in an unlearned script go, a few words of a learned language stay."""
    short = [(3000, "ελλάδα", "xx"), (3001, "日月火水木金", "xx"), (3002, "שלום לך", "xx")]
    own = [(3010 + k, text(l, 2, 100 + k), l) for k, l in enumerate(SYLLABLES)]
    df = docs([*rows, *short, *own]).withColumn("lang", F.when(F.col("doc_id") < 3000, F.col("lang")))
    left = {r.doc_id for r in X.accepted(df).collect()}
    assert not left & {i for i, *_ in short} and {i for i, *_ in own} <= left


def test_the_limit_needs_two_languages_and_enough_texts():
    texts = [text(l, 30, s) for l in SYLLABLES for s in range(40)]
    labels = [l for l in SYLLABLES for _ in range(40)]
    rows = X.presence(texts)
    assert 0.05 < X.least_lead(rows, labels) < 0.5
    assert X.least_lead(rows[:40], labels[:40]) == 0.0 and X.least_lead(rows[::10], labels[::10]) == 0.0
    assert X.least_lead(rows[:0], []) == 0.0


def test_packed_rows_fit_the_same_model_in_little_memory():
    """The driver holds the sample as bits: 2,000 rows are 8 MB, and nothing of 80 MB is made of them."""
    r = np.random.default_rng(5)
    packed = r.integers(0, 256, (2000, X.CELLS // 8), dtype=np.uint8) & r.integers(0, 256, X.CELLS // 8, dtype=np.uint8)
    labels = [("de", "en", "fr", "es")[i % 4] for i in range(len(packed))]
    whole = np.unpackbits(packed, axis=1).astype(bool)
    expected, least = X.fit(whole, labels), X.least_lead(whole, labels)
    tracemalloc.start()
    got, again = X.fit(packed, labels), X.least_lead(packed, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.languages == expected.languages and (got.weights == expected.weights).all() and again == least
    assert peak < 120e6, peak
