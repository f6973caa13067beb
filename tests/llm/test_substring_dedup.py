import hashlib
import random

import numpy as np
import pytest

from layerforge.llm import substring_dedup as X
from layerforge.llm import suffix_array as A
from layerforge.llm import windows as W


def test_suffix_array_and_prefixes():
    rnd = random.Random(10)
    for k in (1, 2, 3, 26):
        for _ in range(40):
            strings = [bytes(rnd.randrange(97, 97 + k) for _ in range(rnd.randint(1, 45))) for _ in range(rnd.randint(1, 9))]
            text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8) + np.uint8(1)
            data, sa = text.tobytes(), A.suffix_array(text)
            assert sorted(sa.tolist()) == list(range(len(text)))
            heads = [data[i:].split(b"\0")[0] for i in sa]
            assert heads == sorted(heads)
            plcp = A.common_prefixes(text, sa, A.words(text))
            for x, y in zip(sa, sa[1:]):
                n = 0
                while max(x, y) + n < len(data) and data[x + n] == data[y + n]:
                    n += 1
                assert plcp[y] == n


def test_least_owner_of_every_window():
    rnd = random.Random(11)
    for _ in range(100):
        base = bytes(rnd.randrange(97, 100) for _ in range(200))
        strings = []
        for _ in range(rnd.randint(1, 10)):
            at = rnd.randint(0, 150)
            s = bytearray(base[at : at + rnd.randint(1, 100)])
            if rnd.random() < 0.5 and s:
                s[rnd.randrange(len(s))] = 120
            strings.append(bytes(s))
        owners = np.array([rnd.randrange(50) for _ in strings])
        for length in (1, 7, 50):
            got, _ = A.least_owner(strings, owners, length)
            least = {}
            for s, o in zip(strings, owners):
                for i in range(len(s) - length + 1):
                    least[s[i : i + length]] = min(least.get(s[i : i + length], 99), o)
            assert got.tolist() == [least[s[i : i + length]] for s in strings for i in range(len(s) - length + 1)]


def test_runs_hold_every_window_once():
    rnd = np.random.default_rng(12)
    for longest in (4096, 5):
        sizes = [0, 3, 50, 49, 51, 400, 0, 90]
        data = rnd.integers(97, 99, sum(sizes)).astype(np.uint8)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        row, first, count, key = W.runs(data, bounds, 50, 24, longest)
        seen = sorted((r, f + i) for r, f, c in zip(row, first, count) for i in range(c))
        assert seen == [(r, i) for r, n in enumerate(sizes) for i in range(max(0, n - 49))]
        assert count.max() <= longest
        # equal windows have one key
        keys = {}
        for r, f, c, k in zip(row, first, count, key):
            for i in range(c):
                at = bounds[r] + f + i
                assert keys.setdefault(data[at : at + 50].tobytes(), k) == k


def brute(rows, length=50):
    out = []
    starts = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for k in range(len(b) - length + 1):
                w = b[k : k + length]
                starts[w] = min(starts.get(w, i), i)
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        if i is not None:
            for k in range(len(b) - length + 1):
                if starts[b[k : k + length]] < i:
                    gone[k : k + length] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_bytes", [1 << 23, 3000])
def test_what_goes_is_what_brute_force_says(docs, tokens, bucket_bytes):
    rnd = random.Random(13)
    passages = [" ".join(tokens(rnd.randint(8, 60), 300 + i)) + " é日本" for i in range(8)]
    rows = []
    for i in range(70):
        parts = [" ".join(tokens(rnd.randint(0, 40), i))]
        for _ in range(rnd.randint(0, 3)):
            parts.append(rnd.choice(passages))
            parts.append(" ".join(tokens(rnd.randint(0, 20), 1000 + i)))
        rows.append((rnd.randrange(10_000) * 100 + i, " ".join(parts)))
    copy = rows[3][1]
    rows += [(5_000_000 + i, copy) for i in range(12)]
    rows += [(2, None), (3, ""), (4, "short"), (5, "a" * 49), (6, "a" * 50), (7, "a" * 51), (8, "b" * 5000), (9, "b" * 9000),
             (10, "ab" * 3000), (11, passages[0]), (12, passages[0]), (12, passages[0]), (None, passages[1]), (None, None),
             (13, "x" * 25 + passages[2][:60]), (14, "日" * 40), (15, "日" * 41)]
    # several texts under one id, which share strings with each other and with larger ids
    rows += [(16, "first " + passages[3] + passages[4]), (16, passages[4] + " second"), (16, passages[5] + passages[3]),
             (16, passages[4] + " second"), (17, "x" + passages[4]), (17, passages[5] + passages[3]), (18, "y" + passages[5] + passages[4])]
    got = X.substring_dedup(docs(rows), bucket_bytes=bucket_bytes)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_several_texts_of_an_id_all_count(docs, tokens):
    s, u = (" ".join(tokens(14, k))[:80].ljust(80, "q") for k in (1, 2))
    rows = [(1, s), (1, u), (2, "x" + s), (4, "q" + s + u)]
    got = sorted(tuple(r) for r in X.substring_dedup(docs(rows)).collect())
    assert got == brute(rows)
    assert [(i, n) for i, _, n, *_ in got] == [(1, 0), (1, 0), (2, 80), (4, 160)]


def test_a_batch_sends_a_string_once():
    import pyarrow as pa

    rnd = random.Random(21)
    passage = "".join(rnd.choice("abcdefghij ") for _ in range(300))
    texts = [f"{i:05d} {passage} {i:05d}" for i in range(500)]
    hashes = np.concatenate([h for *_, h in X._text_runs(pa.array(texts), 50, 24)])
    marks = np.unique(X._marks(hashes, 4)).tolist()
    batch = pa.RecordBatch.from_pydict({"id": range(500), "h": range(500), "text": texts, "marks": [marks] * 500})
    packed = X._packed(batch, 0, 50, 24, 4).to_pydict()
    shared = [x for x in (b"".join(packed["strings"]),) if x][0]
    assert shared.count(passage[120:180].encode()) <= 3  # in overlapping runs, not once a text
    assert sum(len(k) // 4 for k in packed["kinds"]) == len(hashes)
    assert sum(len(x) // 4 for x in packed["sizes"]) < len(hashes) / 2


def test_no_rows(docs):
    assert X.substring_dedup(docs([(1, "a")]).limit(0)).collect() == []
    with pytest.raises(ValueError):
        X.substring_dedup(docs([(1, "a")]), length=60)
