"""Prefix trie against plain Python over rebuilt sequences."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from layerforge.llm import prefix_trie as P

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("depth", T.StringType()), T.StructField("ka", T.StringType()),
])
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows, partitions=5):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(partitions)


def plain(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    members = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append((c, d == len(whole)))
    kids = {}
    for n in members:
        if n:
            kids.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        below = kids.get(n, [])
        leaves[n] = sum(leaves[k] for k in below) or 1
        words = len(WORDS.findall(n[-1][1])) if n else 0
        saved[n] = (len(members[n]) - 1) * words + sum(saved[k] for k in below)
    out = []
    for n, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, e in m if e))
        out.append((min(c for c, _ in m), len(n), min(c for c, _ in members[n[:-1]]) if n else None, len(m),
                    len(kids.get(n, [])), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def talk(seed, n=120):
    r = random.Random(seed)
    openings = [("system", "be kind"), ("system", "be  short\n"), (None, None), ("", "")]
    rows = []
    for c in r.sample(range(400), n):
        for t in range(r.randint(0, 6)):
            role, text = r.choice(openings) if t < 2 and r.random() < 0.8 else ("user", f"say {r.randint(0, 6)} and {r.randint(0, 3)}")
            rows.append((c, r.choice([t, t, t, None, 3]), role, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(spark, seed):
    rows = talk(seed)
    rows += [(None, 0, "user", "nobody"), (41, None, None, None), (41, None, None, None), (1000, 0, "user", "alone")]
    rows += [(c, 0, "user", "same start") for c in range(2000, 2060)]  # one-turn copies, some left without a turn
    assert got(P.prefix_trie(table(spark, rows))) == plain(rows)


def test_one_conversation_holds_most_turns(spark, monkeypatch):
    """Crosses partitions and blocks; another one repeats half of it."""
    monkeypatch.setattr(P, "BLOCK", 16)
    rows = [(7, t, "user", f"turn {t % 5} {t % 7}") for t in range(500)]
    rows += [(8, t, "user", f"turn {t % 5} {t % 7}") for t in range(250)]
    rows += [(c, t, "user", f"turn {t % 5}") for c in range(100, 160) for t in range(3)]
    assert got(P.prefix_trie(table(spark, rows))) == plain(rows)


def test_many_equal_conversations(spark, monkeypatch):
    """One node ends with more ids than a run holds."""
    monkeypatch.setattr(P, "BLOCK", 8)
    rows = [(c * 20, t, "user", f"turn {t}") for c in range(90) for t in range(2)]
    rows += [(c * 20 + 1, 9, "user", "own") for c in range(30)]
    assert got(P.prefix_trie(table(spark, rows))) == plain(rows)


def test_no_rows(spark):
    out = P.prefix_trie(table(spark, [(1, 1, "a", "b")]).where("false"))
    assert out.count() == 0 and len(out.columns) == 8


def test_different_turns_of_one_fingerprint_are_noticed(spark):
    nodes = spark.createDataFrame([(0, 0, 0, 0, 1, 1)], "pa long, pa_high long, pb long, pb_high long, words long, words_high long")
    lanes = ", ".join(f"t{i} long" for i in range(4))
    same = spark.createDataFrame([(1, 2, 3, 4, "a", "b"), (1, 2, 3, 4, "a", "b")], f"{lanes}, role string, text string")
    other = spark.createDataFrame([(1, 2, 3, 4, "a", "b"), (1, 2, 3, 4, "a", "c")], f"{lanes}, role string, text string")
    assert not P.ambiguous(same, nodes) and P.ambiguous(other, nodes)
    assert P.ambiguous(same, nodes.selectExpr("1 AS pa", "pa_high", "pb", "pb_high", "words", "words_high"))


def test_powers():
    got = P.powers(12345, np.array([0, 1, 2, 63, 10**12]), P.PRIMES[0])
    assert got.tolist() == [pow(12345, n, P.PRIMES[0]) for n in (0, 1, 2, 63, 10**12)]
