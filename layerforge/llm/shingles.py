"""Word shingles of whole Arrow batches as 64-bit hashes.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased. A
word hashes to a sum of random multipliers, one for each position, times random
values, one for each byte; everything is computed for a slice of documents at a
time, so memory follows the slice (or one long document), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; wraps on purpose."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def random_values(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd numbers."""
    return mixed(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_BYTE_VALUES = random_values(256, 11)
_BYTE_VALUES[65:91] = _BYTE_VALUES[97:123]  # A-Z like a-z
_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_PLACES = random_values(1 << 12, 23)


def _places(n: int) -> np.ndarray:
    global _PLACES
    if n > len(_PLACES):
        _PLACES = random_values(2 * n, 23)
    return _PLACES


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (int64) of a string column; null rows are empty."""
    wide = column.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    bounds = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1] if len(wide) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


def slices(bounds: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer document is a range of its own."""
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(bounds) - 1)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the documents in ``bounds``, and the row of each word."""
    low, high = int(bounds[0]), int(bounds[-1])
    part = data[low:high]
    inside = _IS_WORD[part]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    firsts = (bounds[:-1] - low)[np.diff(bounds) > 0]
    starts[firsts] = inside[firsts]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    begin = np.flatnonzero(starts[at])  # of each word, among the word bytes
    lengths = np.diff(np.append(begin, len(at)))
    place = np.arange(len(at)) - np.repeat(begin, lengths)
    values = _BYTE_VALUES[part[at]] * _places(int(lengths.max()))[place]
    words = mixed(np.add.reduceat(values, begin) + lengths.astype(_U) * _U(0x9E3779B97F4A7C15))
    rows = np.searchsorted(bounds, low + at[begin], "right") - 1
    return words, rows


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every document, in order.

    A document with fewer words than a shingle has is one shingle; without words
    its set is empty. A null is an empty document.
    """
    data, bounds = text_buffers(column)
    for first, last in slices(bounds):
        span = bounds[first : last + 1]
        w, rows = word_hashes(data, span)
        edges = np.searchsorted(rows, np.arange(last - first + 1))
        factors = random_values(words, 41)
        n = len(w) - words + 1
        if n > 0:
            shingles = w[:n] * factors[0]
            for k in range(1, words):
                shingles += w[k : k + n] * factors[k]
            shingles = mixed(shingles)
        for i in range(last - first):
            a, b = edges[i], edges[i + 1]
            if b - a >= words:
                yield first + i, np.unique(shingles[a : b - words + 1])
            elif b > a:
                short = mixed((w[a:b] * factors[: b - a]).sum(keepdims=True) + _U(b - a))
                yield first + i, short
            else:
                yield first + i, np.zeros(0, _U)
