import random
import re

import pytest
from pyspark.sql import functions as F

from layerforge.llm import token_counts as X
from layerforge.llm.bpe import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


def direct(rows):
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    out = {}
    for _, text, lang, source in rows:
        t = text or ""
        counts = {X.WORDS: len(re.findall(r"[^\x20\x09-\x0D]+", t)), X.BPE: len(library.encode(t, add_special_tokens=False).ids)}
        for name, n in counts.items():
            d, tokens, size = out.get((source, lang, name), (0, 0, 0))
            out[source, lang, name] = (d + 1, tokens + n, size + len(t.encode()))
    return out


def read(df):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens, r.bytes) for r in df.collect()}


@pytest.fixture
def rows(tokens):
    rnd = random.Random(14)
    out = [(i, " ".join(tokens(rnd.randint(0, 60), i)), rnd.choice(["en", "de", None]), rnd.choice(["a", "a", "b", None]))
           for i in range(120)]
    return [*out, (500, None, "en", "a"), (501, "", None, None), (502, "<|endoftext|> x y", "en", "b"),
            (503, "long " * 50_000, "de", "b"), (504, "twice", "en", "a"), (504, "twice", "en", "a"), (None, "no id", "en", "a")]


def measured(docs, rows):
    return X.measure(docs(rows), vocabulary_path(), vocabulary_path("byte_bpe_50k.tiktoken"), count_col="counted").withColumn(
        "counts", F.col("counted"))


def test_the_query_gives_the_totals_of_the_table(spark, docs, rows, tmp_path):
    docs(rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    assert read(X.op6(spark, str(tmp_path))) == direct(rows)


def test_batches_commit_once_and_in_any_order(spark, docs, rows, tmp_path):
    counted = measured(docs, rows).persist()
    source, lang = F.col("source"), F.col("lang")
    totals = X.Totals(spark, f"{tmp_path}/t")
    assert totals.read().collect() == []
    gone = F.col("doc_id") % 3 == 0
    totals.apply("2", [X.signed(counted.where(gone), -1, source, lang)])  # arrives first
    for _ in range(3):
        totals.apply("1", [X.signed(counted, 1, source, lang)])
    left = [r for r in rows if r[0] is None or r[0] % 3]
    assert read(totals.read()) == direct(left)
    assert read(totals.compact(f"{tmp_path}/c").read()) == direct(left)


def test_a_repeat_after_folding_counts_no_second_time(spark, docs, tmp_path):
    rows = [(1, "a b c", "en", "s"), (2, "d", "en", "s")]
    load = [X.signed(measured(docs, rows), 1, F.col("source"), F.col("lang"))]
    totals = X.Totals(spark, f"{tmp_path}/t")
    assert totals.apply("load/1", load)
    for i in range(2):  # folded, and folded again
        totals = totals.compact(f"{tmp_path}/c{i}")
        assert not totals.apply("load/1", load)
        assert read(totals.read()) == direct(rows)
    assert totals.apply("base", load)  # a batch may bear any name
    assert not totals.apply("base", load)
    assert read(totals.read()) == direct(rows * 2)
    with pytest.raises(ValueError):
        totals.compact(f"{tmp_path}/t")


def test_a_batch_counts_from_its_marker_on(spark, docs, tmp_path, monkeypatch):
    rows = [(1, "a b c", "en", "s"), (2, "d", "en", "s")]
    load = [X.signed(measured(docs, rows), 1, F.col("source"), F.col("lang"))]
    totals = X.Totals(spark, f"{tmp_path}/t")
    totals.apply("1", load)
    committed = sorted(p for p in (tmp_path / "t").rglob("*") if p.is_file())
    with monkeypatch.context() as m:  # dies when the sums are written, before the marker
        m.setattr(X.Totals, "_files", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            totals._commit("b-2", X.summed(load[0]))
    assert read(totals.read()) == direct(rows)
    assert totals.apply("2", load) and not totals.apply("1", load)
    assert read(totals.read()) == direct(rows * 2)
    assert all(p.exists() for p in committed)


def test_a_new_tokenizer_and_a_new_text(spark, docs, tmp_path):
    before, after = [(1, "a b\nc", "en", "s")], [(1, "a b\nc d", "en", "s")]
    old, new = measured(docs, before), measured(docs, after)
    totals = X.Totals(spark, f"{tmp_path}/t")
    source, lang = F.col("source"), F.col("lang")
    totals.apply("load", [X.signed(old, 1, source, lang, (X.SPACED, X.BPE))])
    assert read(totals.read())["s", "en", X.SPACED][1] == 2
    totals.apply("version", [X.signed(old, -1, source, lang, (X.SPACED,)), X.signed(old, 1, source, lang, (X.WORDS,))])
    assert read(totals.read()) == direct(before)
    totals.apply("text", [X.signed(old, -1, source, lang), X.signed(new, 1, source, lang)])
    assert read(totals.read()) == direct(after)


def test_a_revised_count_moves_between_keys(spark, docs, tmp_path):
    rows = [(1, "a b c", "en", "s"), (2, "d", "en", "s")]
    counted = measured(docs, rows)
    totals = X.Totals(spark, f"{tmp_path}/t")
    totals.apply("load", [X.signed(counted, 1, F.col("source"), F.lit("und"))])
    totals.apply("fix", [X.signed(counted, -1, F.col("source"), F.lit("und")), X.signed(counted, 1, F.col("source"), F.col("lang"))])
    assert read(totals.read()) == direct(rows)  # nothing is left under "und"


def test_no_rows(spark, docs, tmp_path):
    totals = X.Totals(spark, f"{tmp_path}/t")
    empty = measured(docs, [(1, "a")]).limit(0)
    totals.apply("none", [X.signed(empty, 1, F.col("source"), F.col("lang"))])
    assert totals.read().collect() == []
