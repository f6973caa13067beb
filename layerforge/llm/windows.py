"""Minimizer runs of byte windows, for whole Arrow batches."""

from __future__ import annotations

import numpy as np

from layerforge.llm.shingles import mixed, random_values

_U = np.uint64
_VALUES = random_values(256, 77)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each position on, by doubling."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.zeros(0, _U)
    power = _VALUES[data]
    size, out, done = 1, None, 0
    factor = _U(0x9E3779B97F4A7C15)
    while True:
        if gram & size:
            # append this block to the right of what is there
            out = power[: len(data) - size + 1] if out is None else (
                out[: len(data) - done - size + 1] * factor + power[done : len(data) - size + 1]
            )
            done += size
        if size * 2 > gram:
            break
        power = power[: len(power) - size] * (factor + _U(2 * size)) + power[size:]
        size *= 2
    return mixed(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs(data: np.ndarray, bounds: np.ndarray, length: int, gram: int, longest: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of ``length`` bytes that share their smallest gram, by value.

    ``bounds`` are the offsets of documents in ``data``; no window crosses one.
    Returns, for each run: row, first window (offset in the document), number of
    windows (``longest`` at most) and the gram's hash.
    """
    low, high = int(bounds[0]), int(bounds[-1])
    if high - low < length:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros(0, _U)
    smallest = sliding_min(gram_hashes(data[low:high], gram), length - gram + 1)
    n = len(smallest)  # windows, those across bounds included
    starts = np.concatenate([[True], smallest[1:] != smallest[:-1]])
    offsets = bounds - low
    size = np.diff(offsets)
    starts[offsets[:-1][(offsets[:-1] < n) & (size > 0)]] = True
    # a document ends with windows that reach into the next one; they form runs of their own
    ends = offsets[1:] - length + 1
    cut = ends[(ends > 0) & (ends < n) & (size >= length)]
    starts[cut] = True
    first = np.flatnonzero(starts)
    count = np.diff(np.append(first, n))
    row = np.searchsorted(offsets, first, "right") - 1
    inside = first + length <= offsets[row + 1]
    first, count, row = first[inside], count[inside], row[inside]
    if len(count) and count.max() > longest:
        pieces = -(-count // longest)
        base = np.repeat(first, pieces)
        turn = np.arange(len(base)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        left = np.repeat(count, pieces) - turn * longest
        first, count, row = base + turn * longest, np.minimum(left, longest), np.repeat(row, pieces)
    return row, first - offsets[row], count, smallest[first]
