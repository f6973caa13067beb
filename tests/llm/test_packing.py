import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from layerforge.llm import packing as P
from layerforge.llm.bpe import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


def brute(cuts, penalties, size):
    points = [0, *cuts]
    cost_of = dict(zip(cuts, penalties))

    @lru_cache(None)
    def best(j):
        if j == 0:
            return 0.0
        out = float("inf")
        for i in range(j):
            n = points[j] - points[i]
            if n <= size:
                pad = 0 if n & (n - 1) == 0 and n >= P.SHORTEST else size - n
                out = min(out, best(i) + pad + cost_of[points[j]])
        return out

    return best(len(points) - 1)


def test_the_plan_is_the_cheapest():
    rnd = random.Random(6)
    for _ in range(60):
        cuts = np.cumsum([rnd.randint(1, 400) for _ in range(rnd.randint(1, 25))]).tolist()
        penalties = [rnd.choice([0.0, 1.0, 8.0]) for _ in cuts]
        chosen = P.plan(cuts, penalties, 1024)
        cost, at = 0.0, 0
        for c in chosen:
            n = c - at
            assert 0 < n <= 1024 and c in cuts
            cost += (0 if n & (n - 1) == 0 and n >= P.SHORTEST else 1024 - n) + penalties[cuts.index(c)]
            at = c
        assert at == cuts[-1] and cost == brute(cuts, penalties, 1024)


def test_pieces_cover_every_document_once(docs, tokens):
    rows = [(i, " ".join(tokens(random.Random(i).randint(0, 900), i)) + ". End!\n" * (i % 3)) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "nostop " * 30_000), (503, "<|endoftext|>"), (504, "!" * 500),
             (505, "twice."), (505, "twice."), (None, "no id")]
    library = tokenizers.Tokenizer.from_file(vocabulary_path())
    got = P.pack(docs(rows), vocabulary_path(), vocabulary_path("byte_bpe_50k.tiktoken")).collect()
    ids = {i: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in rows}
    windows, pieces = {}, {}
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length > 0 and zlib.crc32(part.tobytes()) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id])
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for i, parts in pieces.items():
        copies = sum(1 for j, _ in rows if j == i)
        assert sum(n for _, n in parts) == copies * len(ids[i])
        if copies == 1:
            at = 0
            for start, n in sorted(parts):
                assert start == at
                at += n
    assert set(pieces) == set(ids)
    used = padded = 0
    for parts in windows.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024
        used, padded = used + at, padded + (0 if at & (at - 1) == 0 else 1024 - at)
    assert padded < 0.05 * used  # three partitions, each with one open end


def test_no_rows(docs):
    got = P.pack(docs([(1, "a")]).limit(0), vocabulary_path(), vocabulary_path("byte_bpe_50k.tiktoken"))
    assert got.collect() == []
