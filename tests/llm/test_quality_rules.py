"""Quality rules against plain Python: counts, model and verdicts."""

import math
import re
from collections import Counter

import pytest

from layerforge.llm import quality_rules as Q

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    again = {i + k for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    letters = [c for c in text if c.isalpha()]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again), "n_lines": len(lines),
        "n_letters": len(letters), "n_upper": sum(c.isupper() for c in letters), "n_bangs": text.count("!"),
        "n_letter_words": sum(any(c.isalpha() for c in w) for w in words), "longest_word": max(map(len, words), default=0),
    }


def plain_votes(c):
    def holds(condition):
        return eval(condition.replace(" = ", " == ").replace("AND", "and").replace("OR", "or"), {}, c)

    return tuple(-1 if holds(r.bad) else 1 if holds(r.good) else 0 for r in Q.RULES)


def plain_model(votes):
    def rate(v, prior, good, bad):
        odds = math.log(prior / (1 - prior))
        for j, x in enumerate(v):
            odds += {1: math.log(good[j] / (1 - bad[j])), -1: math.log((1 - good[j]) / bad[j]), 0: 0.0}[x]
        return 1 / (1 + math.exp(-odds))

    k = len(Q.RULES)
    prior, good, bad = Q.FIRST_PRIOR, [Q.FIRST_GOOD] * k, [Q.FIRST_BAD] * k
    for _ in range(Q.ROUNDS):
        w = [rate(v, prior, good, bad) for v in votes]
        prior = min(max((sum(w) + 2 * Q.FIRST_PRIOR) / (len(w) + 2), 0.01), 0.99)
        for j in range(k):
            voted = sum(x for x, v in zip(w, votes, strict=True) if v[j])
            right = sum(x for x, v in zip(w, votes, strict=True) if v[j] == 1)
            g = min(max((right + 2 * Q.FIRST_GOOD) / (voted + 2), Q.LEAST_GOOD), Q.SURE)
            voted = sum(1 - x for x, v in zip(w, votes, strict=True) if v[j])
            right = sum(1 - x for x, v in zip(w, votes, strict=True) if v[j] == -1)
            bad[j] = max(min((right + 2 * Q.FIRST_BAD) / (voted + 2), Q.SURE), 1 - g)
            good[j] = g
    return lambda v: rate(v, prior, good, bad)


def texts(tokens):
    rows = [(i, " ".join(tokens(80 + i, i)).capitalize() + ".\nAnd " + " ".join(tokens(30, 500 + i)) + ".\nEnd of " + " ".join(tokens(9, 900 + i)))
            for i in range(60)]
    rows += [(100 + i, " | ".join(tokens(90, 100 + i))) for i in range(6)]
    rows += [(200 + i, "\n".join(" ".join(w + "$$$" for w in tokens(20, 200 + i * 7 + j)) for j in range(5))) for i in range(6)]
    rows += [(300 + i, "\n".join(" ".join(w.upper() + "!!" for w in tokens(30, 300 + i * 4 + j)) for j in range(4))) for i in range(6)]
    part = " ".join(tokens(12, 7))
    rows += [(400, part + " x " + part), (401, "\n".join([part] * 9)), (402, " ".join(["same"] * 5000)),
             (403, ""), (404, None), (405, " \t\n\x0b"), (406, "w" * 100_000), (407, "é ß Ünï x 中文 😀😀 | a\n\na\r\na"),
             (407, "again the same id"), (None, "no id"), (408, "a b c d e f g h a b c d e f g h a b c d e f g"),
             (409, "\nled by a line\n led by a line\nled by a line")]
    return rows


def test_against_plain_python(spark, docs, tokens):
    rows = texts(tokens)
    got = Q.quality(docs(rows)).collect()
    assert len(got) == len(rows)
    want = Counter()
    counted = [(i, plain_counts(t)) for i, t in rows]
    failed = [c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"] for _, c in counted]
    rate = plain_model([plain_votes(c) for (_, c), f in zip(counted, failed, strict=True) if not f])
    for (i, c), f in zip(counted, failed, strict=True):
        p = rate(plain_votes(c))
        want[(i, *c.values(), f, round(p, 6), not f and p >= Q.KEEP_FROM)] += 1
    have = Counter((r["doc_id"], *[r[c] for c in plain_counts("")], r["base_failed"], r["quality"], r["kept"]) for r in got)
    assert have == want


def test_junk_goes_and_prose_stays(docs, tokens):
    kept = {r["doc_id"]: r["kept"] for r in Q.quality(docs(texts(tokens))).collect()}
    assert all(kept[i] for i in range(60))
    assert not any(kept[i] for i in kept if i is not None and 100 <= i < 400)


def test_nothing_to_learn_from(spark, docs):
    assert Q.quality(docs([(1, None)]).where("false")).count() == 0
    rows = Q.quality(docs([(1, None), (2, "short"), (2, "short")])).collect()
    assert len(rows) == 3 and all(r["base_failed"] and not r["kept"] for r in rows)


def test_no_python_worker(docs):
    plan = Q.quality(docs([(1, "x y z")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [0, 7, 8, 9, 15, 16, 17])
def test_short_windows(spark, n):
    text = " ".join(["x"] * n)
    got = spark.range(1).select(Q.counts(Q.F.lit(text))["n_repeat_words"]).first()[0]
    assert got == plain_counts(text)["n_repeat_words"]
