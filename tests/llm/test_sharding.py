import random
import zlib
from itertools import product

from layerforge.llm import sharding as S


def test_differencing_places_every_part_once():
    rnd = random.Random(1)
    for k in (2, 3, 8):
        items = [[rnd.randrange(100)] + [0] * (k - 1) for _ in range(30)]
        sums, went = S.differencing(items)
        again = [0] * k
        for parts, to in zip(items, went):
            assert sorted(to) == list(range(k))
            for value, part in zip(parts, to):
                again[part] += value
        assert again == sums and sums == sorted(sums, reverse=True)


def test_differencing_is_near_the_best_split():
    rnd = random.Random(2)
    for _ in range(10):
        sizes = [rnd.randint(1, 50) for _ in range(9)]
        best = min(max(sum(s for s, p in zip(sizes, way) if p == b) for b in (0, 1))
                   for way in product((0, 1), repeat=len(sizes)))
        sums, _ = S.differencing([[s, 0] for s in sizes])
        assert max(sums) <= best * 7 / 6


def check(rows, got, shards=8):
    assert len(got) == len(rows)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=repr)
    assert {r.law for r in got} <= {"bytes"} and {r.grown_shard for r in got} <= {None}
    total = [0] * shards
    for s in range(shards):
        mine = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        total[s] = sum(r.size for r in mine)
    return total


def test_groups_stay_together_and_bytes_are_even(docs):
    rnd = random.Random(3)
    rows = [(i, "x" * rnd.randint(0, 3000)) for i in range(900)] + [(5000 + i, "é same") for i in range(60)]
    rows += [(7000, None), (7000, None), (None, ""), (None, "solo")]
    for fan_in in (4096, 16):  # one block; three levels
        got = S.shard_by_bytes(docs(rows), 8, fan_in=fan_in).collect()
        total = check(rows, got)
        assert max(total) - min(total) <= 0.002 * sum(total)
        text = dict(rows)
        where = {}
        for r in got:
            where.setdefault(text[r.doc_id] if r.doc_id is not None else r.size, set()).add(r.shard)
        assert all(len(w) == 1 for k, w in where.items() if isinstance(k, str))


def test_one_huge_group_and_few_rows(docs):
    rows = [(i, "big " * 50) for i in range(40)] + [(100, "a")]
    check(rows, S.shard_by_bytes(docs(rows), 8).collect())
    check([(1, "a")], S.shard_by_bytes(docs([(1, "a")]), 8).collect())


def test_no_rows(docs):
    assert S.shard_by_bytes(docs([(1, "a")]).limit(0), 8).collect() == []
