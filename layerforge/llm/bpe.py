"""Byte-pair encoding and decoding as streaming transducers.

Encoding. Text is cut into pre-tokens by the tokenizer's pattern, and each
pre-token is merged by the ranked merge list. A pre-token of any length is read
once, from left to right, in constant memory:

* The encoding of a prefix ends in exactly one token, and what stands before
  that token is the encoding of the shorter prefix. Two tokens may stand side by
  side when encoding their joined bytes gives the two back. So one table, "last
  token of the prefix that ends here", is filled byte by byte.
* Every later position chains back through one of the last ``longest`` table
  entries (no token is longer). Where all their chains meet, the tokens before
  are stable and are emitted.
* The merge list has a sufficient lookahead: an influence travels to the left
  only along overlapping merges of falling rank, so the longest such chain, in
  bytes, bounds how far from the read position a token can be unstable. It is
  computed once from the merges, and bounds the table.

Decoding maps ids to bytes and feeds them to an incremental UTF-8 state machine
that holds back an unfinished character and replaces what can never be one.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm.common import register, table, with_fields

# Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DIRECT = 48  # bytes up to which a pre-token is merged in one go
CACHE = 600_000  # remembered words of a generation; there are two
PAIRS = 1_000_000  # remembered answers whether two tokens may stand side by side
CHUNK = 1 << 16  # characters that are cut into pre-tokens at once


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ranked merges over bytes, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_symbols()
        model = spec["model"]
        self.bytes_of: dict[int, bytes] = {
            i: bytes(to_byte[c] for c in token) for token, i in model["vocab"].items()
        }
        ids = {token: i for token, i in model["vocab"].items()}
        self.byte_id = [0] * 256
        for symbol, b in to_byte.items():
            self.byte_id[b] = ids[symbol]
        self.rank_of: dict[tuple[int, int], int] = {}
        self.made: list[int] = []  # by rank: the token that the merge makes
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank_of[ids[left], ids[right]] = rank
            self.made.append(ids[left + right])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.longest = max((len(b) for i, b in self.bytes_of.items() if i not in self.special.values()), default=1)

    @cached_property
    def lookahead(self) -> int:
        """Bytes past a position that can still change the tokens before it.

        Longest chain, by bytes, of merges of falling rank in which a proper
        suffix of one result is a prefix of the next; one pass in rank order.
        """
        best: dict[bytes, int] = {}
        longest = self.longest
        for made in self.made:
            word = self.bytes_of[made]
            reach = len(word) + max((best.get(word[i:], 0) for i in range(1, len(word))), default=0)
            longest = max(longest, reach)
            for i in range(1, len(word) + 1):
                if best.get(word[:i], 0) < reach:
                    best[word[:i]] = reach
        return longest

    @cached_property
    def by_bytes(self) -> dict[bytes, int]:
        """Tokens that encode to themselves; only these can occur in an encoding."""
        special = set(self.special.values())
        return {b: i for i, b in self.bytes_of.items() if i not in special and self.merge(b) == [i]}

    def merge(self, data: bytes) -> list[int]:
        """The merge list applied to a short byte string."""
        byte_id, rank_of, made, never = self.byte_id, self.rank_of, self.made, len(self.made)
        ids = [byte_id[b] for b in data]
        ranks = [rank_of.get(pair, never) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == never:
                break
            at = ranks.index(best)
            ids[at] = made[best]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = rank_of.get((ids[at - 1], ids[at]), never)
            if at < len(ranks):
                ranks[at] = rank_of.get((ids[at], ids[at + 1]), never)
        return ids


class Recent(dict):
    """A bounded memory: the newest entries, and those asked for since the last turn-over."""

    def __init__(self, size: int):
        self.size, self.older = size, {}

    def recall(self, key):
        found = self.older.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key, value) -> None:
        if len(self) >= self.size:
            self.older = dict(self)
            self.clear()
        self[key] = value


class Encoder:
    """Text to ids; holds a bounded number of remembered words and token pairs."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.words, self.spaced = Recent(CACHE // 8), Recent(CACHE)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pre_tokens = regex.compile(PATTERN)
        self.odd_space = regex.compile(r" (?=\s|\Z)")
        self.specials = regex.compile("|".join(map(regex.escape, vocabulary.special))) if vocabulary.special else None

    def _together(self, left: int, right: int) -> bool:
        """Whether two tokens may stand side by side."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.v.merge(self.v.bytes_of[left] + self.v.bytes_of[right]) == [left, right]
            self.pairs[key] = known
        return known

    def stream(self, blocks: Iterable[bytes]) -> Iterator[int]:
        """Ids of one pre-token that arrives in blocks; each id leaves once it is stable."""
        v = self.v
        by_bytes, longest, limit = v.by_bytes, v.longest, v.lookahead + 2 * v.longest + 256
        pending = b""  # bytes from the last emitted boundary on
        last: list[int] = []  # last[i]: last token of the encoding of pending[: i + 1]
        edge = -1  # the token before pending
        for block in blocks:
            for b in block:
                pending += bytes([b])
                end = len(pending)
                for size in range(min(longest, end), 0, -1):
                    token = by_bytes.get(pending[end - size :])
                    if token is None:
                        continue
                    before = last[end - size - 1] if end > size else edge
                    if before < 0 or self._together(before, token):
                        last.append(token)
                        break
                else:
                    raise ValueError("a byte without a token")
                if end >= longest + 256 and end % 64 == 0:
                    cut = self._meeting(last, longest)
                    if end - cut > limit:
                        raise AssertionError("unstable beyond the lookahead of the merge list")
                    if cut:
                        tokens = self._back(last, cut)
                        yield from tokens
                        edge = tokens[-1]
                        pending, last = pending[cut:], last[cut:]
        yield from self._back(last, len(last))

    def _meeting(self, last: list[int], longest: int) -> int:
        """The latest boundary that the chains of all live positions share."""
        size = self.v.bytes_of
        live = set(range(len(last) - longest + 1, len(last) + 1))
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(top - len(size[last[top - 1]]))
        return max(0, live.pop())

    def _back(self, last: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end - 1])
            end -= len(self.v.bytes_of[last[end - 1]])
        return out[::-1]

    def short(self, data: bytes) -> list[int]:
        """Ids of a short pre-token: the longest tokens that may stand side by side.

        A prefix has one encoding only, so a boundary from which no token goes on
        is dead for good, and no boundary is tried twice.
        """
        get, pairs, end = self.v.by_bytes.get, self.pairs, len(data)
        out: list[int] = []
        dead: set[int] = set()
        at, size = 0, min(end, self.v.longest)
        while at < end:
            while size:
                token = get(data[at : at + size])
                if token is not None and at + size not in dead:
                    if not out:
                        break
                    fits = pairs.get((out[-1], token))
                    if self._together(out[-1], token) if fits is None else fits:
                        break
                size -= 1
            if size:
                out.append(token)
                at += size
                size = end - at
            else:
                dead.add(at)
                size = len(self.v.bytes_of[out.pop()])
                at -= size
                size -= 1
        return out

    def _pre_token(self, piece: str) -> list[int]:
        data = piece.encode("utf-8", "surrogatepass")
        return self.short(data) if len(data) <= DIRECT else list(self.stream([data]))

    def _word(self, piece: str) -> tuple[int, ...]:
        """Ids of a piece that starts and ends where pre-tokens do."""
        out: list[int] = []
        for p in self.pre_tokens.findall(piece):
            out += self._pre_token(p)
        return tuple(out)

    def _remembered(self, memory: Recent, key: str, piece: str) -> tuple[int, ...]:
        found = memory.recall(key)
        if found is None:
            found = self._word(piece)
            if len(key) <= DIRECT:
                memory.keep(key, found)
        return found

    def _words(self, text: str, lead: str = "") -> list[tuple[int, ...]]:
        """Ids of a text word by word, cut at single spaces; ``lead`` comes before the text.

        A space before a non-space always starts a pre-token.
        """
        words = text.split(" ")
        found = list(map(self.spaced.get, words))
        if not lead:
            found[0] = self._remembered(self.words, words[0], words[0])
        if None in found:
            for i, known in enumerate(found):
                if known is None:
                    found[i] = self._remembered(self.spaced, words[i], " " + words[i])
        return found

    def _chunk(self, chunk: str) -> list[tuple[int, ...]]:
        """Ids of a text that starts and ends where pre-tokens do."""
        lead = " " if chunk.startswith(" ") else ""
        if self.odd_space.search(chunk):
            return [tuple(self._pre_token(p)) for p in self.pre_tokens.findall(chunk)]
        return self._words(chunk[1:] if lead else chunk, lead)

    def _plain(self, text: str) -> Iterator[list[tuple[int, ...]]]:
        """A text without special tokens, in chunks that end between two pre-tokens."""
        at, size = 0, CHUNK
        while at < len(text):
            end = at + size
            if end < len(text):
                # a space between non-spaces; if the chunk has none, a larger chunk is read
                cut = text.rfind(" ", at + 1, end)
                while cut > at and (text[cut + 1].isspace() or text[cut - 1].isspace()):
                    cut = text.rfind(" ", at + 1, cut)
                if cut <= at:
                    size *= 2
                    continue
                end = cut
            yield self._chunk(text[at:end])
            at, size = end, CHUNK

    def pieces(self, text: str) -> Iterator[list[tuple[int, ...]]]:
        """Ids of a text, a chunk at a time."""
        at = 0
        for m in self.specials.finditer(text) if self.specials else ():
            yield from self._plain(text[at : m.start()])
            yield [(self.v.special[m.group()],)]
            at = m.end()
        yield from self._plain(text[at:] if at else text)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for chunk in self.pieces(text):
            ids.extend(chain.from_iterable(chunk))
        return ids


class Decoder:
    """Ids to text, block by block."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes_of = [vocabulary.bytes_of.get(i, b"") for i in range(max(vocabulary.bytes_of) + 1)]

    def blocks(self, ids: list[int], size: int = 1 << 16) -> Iterator[str]:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for at in range(0, len(ids), size):
            yield machine.decode(b"".join(map(self.bytes_of.__getitem__, ids[at : at + size])))
        yield machine.decode(b"", True)

    def decode(self, ids: list[int]) -> str:
        return "".join(self.blocks(ids))


_LOADED: dict[str, tuple[Encoder, Decoder]] = {}


def coder(path: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a vocabulary file; loaded once in a Python worker."""
    if path not in _LOADED:
        v = Vocabulary(path)
        _LOADED[path] = (Encoder(v), Decoder(v))
    return _LOADED[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_column(docs: DataFrame, path: str, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with an array of ids; a column of that name is replaced. Null text: empty array."""
    kept = docs.drop(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = coder(path)
        for b in batches:
            ids = [encoder.encode(t or "") for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*b.schema.names, ids_col]
            )

    return kept.mapInArrow(run, with_fields(kept, **{ids_col: "array<int>"}))


def decode_column(docs: DataFrame, path: str, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of an array of ids; null ids give an empty text."""
    kept = docs.drop(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = coder(path)
        for b in batches:
            texts = [decoder.decode(i or []) for i in b.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, text_col]
            )

    return kept.mapInArrow(run, with_fields(kept, **{text_col: "string"}))


def round_trip(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, then decode, every text: its id, n_tokens, ids_sha256 and decoded_sha256.

    Ids and decoded text stay in the task that makes them, one text at a time.
    Null text counts as empty (0 tokens); null or repeated ids are kept as they are.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coder(path)
        decimal = [str(i) for i in range(len(decoder.bytes_of))]
        for b in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in b.column("_text"):
                ids = encoder.encode(text.as_py() or "")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                sha = hashlib.sha256()
                for block in decoder.blocks(ids):
                    sha.update(block.encode())
                text_sha.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                names=["_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    done = picked.mapInArrow(run, f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return done.withColumnRenamed("_id", id_col)


@register("op2_bpe_round_trip")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), vocabulary_path())
