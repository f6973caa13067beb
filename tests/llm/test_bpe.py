import hashlib
import random

import pytest

from layerforge.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

ODD = ["", " ", "  ", "\n", " \n a", "<|endoftext|>", "a<|endoftext|> b", "<|endo", "'s 'll'", "日本語テキスト",
       "👍🏽 é é", "\x1c\x00", "²½Ⅷ", "a  b   c ", "-" * 3000, "ab" * 2000, " " * 700 + "x", "word " * 40_000,
       "x" * 70_000, "=" * 65_536 + " end", "\r\n\t mixed  space"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.vocabulary_path())


def test_ids_and_texts_are_the_librarys(library):
    encoder, decoder = bpe.coder(bpe.vocabulary_path())
    rnd = random.Random(4)
    bits = [*ODD[:14], "the", "in", "ing", "thion", ".", ",", "1", "23", "ß", "‍", "<|"]
    texts = ODD + ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40))) for _ in range(1500)]
    texts += ["".join(rnd.choice("abcdeintrhso") for _ in range(rnd.randint(40, 300))) for _ in range(100)]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = encoder.encode(text)
        assert ids == want.ids, text[:50]
        assert decoder.decode(ids) == library.decode(want.ids, skip_special_tokens=False) == text


def test_a_pre_token_may_come_in_blocks():
    encoder, _ = bpe.coder(bpe.vocabulary_path())
    rnd = random.Random(5)
    for _ in range(20):
        data = "".join(rnd.choice("aeinrstz") for _ in range(rnd.randint(60, 2500))).encode()
        want = encoder.v.merge(data)
        assert encoder.short(data) == want
        cuts = sorted(rnd.sample(range(len(data)), 5))
        blocks = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
        assert list(encoder.stream(blocks)) == want


def test_the_stream_emits_before_its_input_ends():
    encoder, _ = bpe.coder(bpe.vocabulary_path())
    seen = 0

    def endless():
        nonlocal seen
        while True:
            seen += 1
            yield b"abcdefghij" * 20

    first = next(iter(encoder.stream(endless())))
    assert first == encoder.v.merge(b"abcdefghij" * 20)[0]
    assert seen * 200 <= encoder.v.lookahead + 2 * encoder.v.longest + 456


def test_decoding_by_blocks_holds_back_half_a_character():
    encoder, decoder = bpe.coder(bpe.vocabulary_path())
    text = "日本👍é" * 50
    ids = encoder.encode(text)
    for size in (1, 2, 7):
        assert "".join(decoder.blocks(ids, size)) == text
    half = [encoder.v.byte_id[b] for b in "👍".encode()[:2]]
    assert decoder.decode(half) == "�"


def test_columns_and_digests(docs, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(90, None), (90, None), (None, "no id")]
    df = docs(rows)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, bpe.vocabulary_path()).collect()}
    want = set()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == want
    both = bpe.decode_column(bpe.encode_column(df, bpe.vocabulary_path()), bpe.vocabulary_path())
    assert all(r.decoded == (r.text or "") for r in both.collect())
    assert bpe.round_trip(df.limit(0), bpe.vocabulary_path()).collect() == []
