"""Suffix arrays of many short strings by induced sorting, and their common prefixes.

All steps work on whole numpy arrays. Strings are joined by separators (0) that
are smaller than every symbol. Order is exact for the first ``DEPTH`` symbols.
"""

from __future__ import annotations

import numpy as np

DEPTH = 56


def words(text: np.ndarray) -> np.ndarray:
    """The eight symbols from each position on as one number, first symbol highest."""
    padded = np.concatenate([text, np.zeros(DEPTH + 8, np.uint8)])
    two = (padded[:-1].astype(np.uint16) << 8) | padded[1:]
    four = (two[:-2].astype(np.uint32) << 16) | two[2:]
    return (four[:-4].astype(np.uint64) << np.uint64(32)) | four[4:]


def small_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol is the sentinel."""
    n = len(text)
    up = np.empty(n, np.int8)
    up[-1] = 1
    up[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    decided = np.where(up != 0, np.arange(n), n - 1)
    return up[np.minimum.accumulate(decided[::-1])[::-1]] > 0


def sorted_lms(text: np.ndarray, small: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Leftmost-smaller positions by their suffixes: eight symbols, then recursively the ties."""
    at = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    key = word[at]
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    for depth in range(8, DEPTH, 8):
        tied = ~new
        tied[:-1] |= ~new[1:]
        idx = np.flatnonzero(tied)
        if not len(idx):
            break
        group, part = np.cumsum(new)[idx], at[idx]
        key = word[np.minimum(part + depth, len(word) - 1)]
        order = np.lexsort((key, group))
        at[idx], key = part[order], key[order]
        # groups keep their places, so group numbers are as before
        new[idx] = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
    return at


def suffix_array(text: np.ndarray, word: np.ndarray | None = None) -> np.ndarray:
    """Suffix array of uint8 ``text``, whose last symbol is 0."""
    n = len(text)
    word = words(text) if word is None else word
    small = small_types(text)
    if n == 1:
        return np.zeros(1, np.int64)
    lms = sorted_lms(text, small, word)
    count = np.bincount(text, minlength=256)
    first = np.concatenate([[0], np.cumsum(count)])
    sa = np.full(n, -1, np.int32)
    lms_first = np.concatenate([[0], np.cumsum(np.bincount(text[lms], minlength=256))])

    # larger-type suffixes, symbol by symbol from the left
    head = first[:-1].copy()

    def forward(seg: np.ndarray) -> None:
        before = seg[seg > 0] - 1
        before = before[~small[before]]
        symbol = text[before]
        order = np.argsort(symbol, kind="stable")
        before, sizes = before[order], np.bincount(symbol, minlength=256)
        at = 0
        for s in np.flatnonzero(sizes):
            k = sizes[s]
            sa[head[s] : head[s] + k] = before[at : at + k]
            head[s] += k
            at += k

    for s in range(256):
        done = first[s]
        while done < head[s]:
            end = head[s]
            forward(sa[done:end].copy())
            done = end
        if lms_first[s] < lms_first[s + 1]:
            forward(lms[lms_first[s] : lms_first[s + 1]])

    # smaller-type suffixes, symbol by symbol from the right
    tail = first[1:].copy()
    larger_end = head.copy()
    sa[0] = n - 1  # the sentinel

    def backward(seg: np.ndarray) -> None:
        before = seg[seg > 0] - 1
        before = before[small[before]]
        symbol = text[before]
        order = np.argsort(symbol, kind="stable")
        before, sizes = before[order], np.bincount(symbol, minlength=256)
        at = 0
        for s in np.flatnonzero(sizes):
            k = sizes[s]
            sa[tail[s] - k : tail[s]] = before[at : at + k][::-1]
            tail[s] -= k
            at += k

    for s in range(255, -1, -1):
        done = first[s + 1]
        while done > tail[s]:
            end = tail[s]
            backward(sa[end:done][::-1].copy())
            done = end
        if s == 0:
            break  # nothing is smaller than a separator
        if first[s] < larger_end[s]:
            backward(sa[first[s] : larger_end[s]][::-1].copy())
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Permuted: symbols that the suffix at each position shares with the one before it in order.

    Where the neighbour moves along with the position, the value falls by one;
    only the other positions are compared, eight symbols at a time.
    """
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    chained = np.zeros(n, bool)
    chained[1:] = (phi[1:] == phi[:-1] + 1) & (phi[:-1] >= 0) & (text[:-1] == text[np.maximum(phi[1:] - 1, 0)])
    heads = np.flatnonzero(~chained & (phi >= 0))
    shared = np.zeros(len(heads), np.int64)
    live = np.arange(len(heads))
    a, b = heads, phi[heads]
    last = len(word) - 1
    while len(live):
        x = word[np.minimum(a, last)] ^ word[np.minimum(b, last)]
        same = (x == 0) & (np.maximum(a, b) + 8 < n)
        differ = ~same
        # leading equal bytes of the words that differ
        y = x[differ]
        lead = np.zeros(len(y), np.int64)
        open_ = np.ones(len(y), bool)
        for k in range(8):
            open_ &= ((y >> np.uint64(56 - 8 * k)) & np.uint64(255)) == 0
            lead += open_
        shared[live[differ]] += lead
        shared[live[same]] += 8
        live, a, b = live[same], a[same] + 8, b[same] + 8
    out = np.zeros(n, np.int64)
    out[heads] = shared
    start = np.maximum.accumulate(np.where(chained, 0, np.arange(n)))
    return np.maximum(out[start] - (np.arange(n) - start), 0)


def least_owner(strings: list[bytes], owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every window of ``length`` bytes: the least owner of a string that holds the same window.

    Returns the values of all windows, string after string, and where each
    string's windows begin. ``length`` is at most DEPTH; strings hold no byte 255.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    windows = np.maximum(sizes - length + 1, 0)
    begins = np.concatenate([[0], np.cumsum(windows)])
    if not begins[-1]:
        return np.zeros(0, np.int64), begins
    text = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8) + np.uint8(1)
    word = words(text)
    sa = suffix_array(text, word)
    prefix = common_prefixes(text, sa, word)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    offset = np.arange(len(text)) - starts[owner]
    valid = offset + length <= sizes[owner]
    ok = valid[sa]
    breaks = prefix[sa] < length
    breaks[1:] |= ~ok[:-1]
    breaks[0] = True
    at, first = sa[ok], np.flatnonzero(breaks[ok])
    least = np.minimum.reduceat(owners[owner[at]], first)
    out = np.empty(begins[-1], np.int64)
    out[begins[owner[at]] + offset[at]] = np.repeat(least, np.diff(np.append(first, len(at))))
    return out, begins
