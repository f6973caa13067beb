"""Packing of token streams into windows by order-preserving dynamic programming.

The token stream of a partition, in input order, is cut where a document or a
sentence ends and, at a higher penalty, inside a long sentence. For cut
points c0 < c1 < ... the cost of the best packing up to cj is

    f[j] = min over i, cj - ci <= size, of  f[i] + padding(cj - ci) + penalty[j]

with padding(n) = size - n, so f[i] + ci is all that matters of i: the minimum
over the sliding range of i is the head of a monotone queue, and each cut point
enters and leaves it once. A window whose length is a power of two needs no
padding; those of SHORTEST or more are tried beside the queue.

The stream is packed block by block: the best packing of a block is emitted but for
its last windows, which stay for the next block. It is the best for a block, not
for a partition: over blocks of 65,536 tokens the cost can be a tenth above that of
one plan for all. Memory holds one document and one block, and one window of a
partition at most is not full.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerforge.llm.bpe import PATTERN, vocabulary_path
from layerforge.llm.common import register, table

SIZE = 1024
SHORTEST = 256  # smallest power of two that a window is closed at for its own sake
END_OF_DOCUMENT = 0
SENTENCE_PENALTY = 1.0  # in padding tokens, for a document cut where a sentence ends
INSIDE_PENALTY = 8.0  # and for one cut inside a sentence
STEP = 32  # a sentence with more tokens may be cut after each so many
BLOCK = 1 << 16  # tokens that are planned at once
PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def plan(cuts: list[int], penalties: list[float], size: int = SIZE) -> list[int]:
    """Cheapest windows over [0, cuts[-1]]: the chosen cut points, in order.

    ``cuts`` rise, and no gap between neighbours (nor from 0) exceeds ``size``.
    Ties go to the longer window.
    """
    points = [0, *cuts]
    cost = [0.0] * len(points)
    back = [0] * len(points)
    queue: deque[int] = deque([0])  # indices of rising f[i] + c[i]
    where = {0: 0}
    powers = [1 << k for k in range(size.bit_length()) if SHORTEST <= 1 << k < size]
    for j in range(1, len(points)):
        c = points[j]
        while points[queue[0]] < c - size:
            queue.popleft()
        i = queue[0]
        best, came = cost[i] + points[i] + size - c, i
        for p in powers:
            i = where.get(c - p)
            if i is not None and cost[i] < best:
                best, came = cost[i], i
        cost[j], back[j] = best + penalties[j - 1], came
        value = cost[j] + c
        while queue and cost[queue[-1]] + points[queue[-1]] > value:
            queue.pop()
        queue.append(j)
        where[c] = j
    chosen = []
    j = len(points) - 1
    while j:
        chosen.append(points[j])
        j = back[j]
    return chosen[::-1]


class Packer:
    """Documents in, pieces (document, start, length, ids, window, offset) out."""

    def __init__(self, sentence_end: np.ndarray, size: int = SIZE, block: int = BLOCK):
        self.sentence_end, self.size, self.block = sentence_end, size, block
        self.pending: list[tuple[int, int, np.ndarray, bool]] = []  # document, start, ids, its last ones
        self.held = 0
        self.window = 0

    def add(self, document: int, ids: np.ndarray) -> Iterator[tuple]:
        """``ids`` with the end mark. Long documents come in blocks."""
        for at in range(0, len(ids), self.block):
            part = ids[at : at + self.block]
            self.pending.append((document, at, part, at + len(part) == len(ids)))
            self.held += len(part)
            if self.held >= self.block:
                yield from self._emit(last=False)

    def finish(self) -> Iterator[tuple]:
        if self.held:
            yield from self._emit(last=True)

    def _cuts(self) -> tuple[list[int], list[float]]:
        stream = np.concatenate([ids for _, _, ids, _ in self.pending])
        penalty = np.full(len(stream) + 1, np.inf)
        penalty[1:][self.sentence_end[stream]] = SENTENCE_PENALTY
        ends = np.cumsum([len(ids) for _, _, ids, _ in self.pending])
        penalty[ends[[closes for *_, closes in self.pending]]] = 0.0
        if np.isinf(penalty[-1]):
            penalty[-1] = INSIDE_PENALTY
        cuts = np.flatnonzero(np.isfinite(penalty))
        bounds = np.concatenate([[0], cuts])
        inside = np.arange(len(stream) + 1) - np.repeat(bounds, np.diff([*bounds, len(stream) + 1]))
        more = np.flatnonzero((inside > 0) & (inside % STEP == 0))
        penalty[more] = INSIDE_PENALTY
        cuts = np.flatnonzero(np.isfinite(penalty))
        return cuts.tolist(), penalty[cuts].tolist()

    def _emit(self, last: bool) -> Iterator[tuple]:
        cuts, penalties = self._cuts()
        chosen = plan(cuts, penalties, self.size)
        if not last:
            # the last windows stay: the next block may fill them better
            keep = bisect_left(chosen, chosen[-1] - 2 * self.size)
            chosen = chosen[: max(1, keep)]
        begin = at = 0  # of the window; of the pending part
        queue = deque(self.pending)
        for end in chosen:
            while queue and at < end:
                document, start, ids, closes = queue[0]
                take = min(len(ids), end - at)
                yield document, start, ids[:take], self.window, at - begin
                at += take
                if take == len(ids):
                    queue.popleft()
                else:
                    queue[0] = (document, start + take, ids[take:], closes)
            begin = end
            self.window += 1
        self.pending = list(queue)
        self.held -= at


def sentence_ends(vocabulary: dict[bytes, int], size: int) -> np.ndarray:
    """Which ids close a sentence: tokens that end in a stop or hold a line break."""
    out = np.zeros(size, bool)
    for token, i in vocabulary.items():
        out[i] = token.rstrip(b"\"')").endswith((b".", b"!", b"?")) or b"\n" in token
    return out


_LOADED: dict[str, tuple] = {}


def tokenizer(path: str, ranks_path: str) -> tuple:
    """The tokenizer and its sentence ends; loaded once in a Python worker.

    The rank file holds the vocabulary of ``path``; special strings give their ids.
    """
    if ranks_path not in _LOADED:
        import base64
        import json

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(path, encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}
        encoding = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        ends = sentence_ends(ranks, 1 + max([*ranks.values(), *special.values()]))
        _LOADED[ranks_path] = (encoding, ends)
    return _LOADED[ranks_path]


def pack(
    docs: DataFrame,
    path: str,
    ranks_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SIZE,
) -> DataFrame:
    """All documents in windows of at most ``size`` ids.

    Returns one row a piece: doc_id (named like ``id_col``), start, length,
    ids_crc32, doc_tokens, sequence_id, offset. A document is its ids and one end
    mark (id 0), so null and empty texts are one id long. Pieces of one window
    are offset gapless from 0. Rows that share an id are packed as documents of
    their own; null ids stay null. No rows give no rows.

    The order is that of the input partitions; nothing is shuffled, and one
    window of each partition may stay short. Window numbers hold the partition in
    their upper bits.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, ends = tokenizer(path, ranks_path)
        packer = Packer(ends, size)
        base = TaskContext.get().partitionId() << 40
        names: dict[int, tuple] = {}  # open documents: id and number of tokens
        number = 0

        found: list[tuple] = []

        def collect(pieces: Iterator[tuple]) -> None:
            for d, start, ids, w, offset in pieces:
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                found.append((names[d][0], start, len(ids), crc, names[d][1], base + w, offset))
            first = packer.pending[0][0] if packer.pending else number + 1
            for d in [d for d in names if d < first]:
                del names[d]

        def rows(id_type: pa.DataType) -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * 7
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

        id_type = None
        for b in batches:
            id_type = b.schema.field("_id").type
            for name, text in zip(b.column("_id"), b.column("_text")):
                ids = encoding.encode(text.as_py() or "", allowed_special="all")
                ids.append(END_OF_DOCUMENT)
                names[number] = (name.as_py(), len(ids))
                collect(packer.add(number, np.array(ids, np.uint32)))
                number += 1
                if len(found) > 8192:
                    yield rows(id_type)
        if id_type is not None:
            collect(packer.finish())
            yield rows(id_type)

    picked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return picked.mapInArrow(run, PIECES.format(id=kind)).withColumnRenamed("doc_id", id_col)


@register("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack(docs, vocabulary_path(), vocabulary_path("byte_bpe_50k.tiktoken"))
