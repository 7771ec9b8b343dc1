"""Words and their hashes for whole Arrow batches, without a Python loop over words.

A word is a run of bytes outside 0x20 and 0x09-0x0D. All words of a batch are
found and hashed with array operations over the text column's own buffer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BLOCK = 1 << 21  # bytes hashed at a time; bounds the working arrays
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of MurmurHash3)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_BYTE_VALUE = mixed(np.arange(1, 257, dtype=_U))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _BLOCK + 1), _powers(_INVERSE, _BLOCK + 1)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _edges(solid: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that no cut may lie inside."""
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    inner = cuts[(cuts > 0) & (cuts < len(solid))]
    start[inner] = solid[inner]
    end[inner - 1] = solid[inner - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the number of words before it."""
    start, end = _edges(~_SPACE[data], offsets)
    return start, end, np.searchsorted(start, offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every ``\\n``-separated line, and the number of lines before each row.

    Every row has one line more than it has line feeds.
    """
    feeds = np.flatnonzero(data == 0x0A)
    rows = np.searchsorted(feeds, offsets)
    first = rows + np.arange(len(offsets))
    start = np.empty(len(feeds) + len(offsets) - 1, np.int64)
    end = np.empty_like(start)
    of_feed = np.searchsorted(offsets, feeds, side="right") - 1
    at = np.arange(len(feeds)) + of_feed
    start[first[:-1]], end[first[1:] - 1] = offsets[:-1], offsets[1:]
    end[at], start[at + 1] = feeds, feeds + 1
    return start, end, first


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte as it is."""
    return np.where((data >= 0x41) & (data <= 0x5A), data | 0x20, data)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span; spans are in order and do not overlap."""
    out = np.empty(len(start), _U)
    value = _BYTE_VALUE if seed == 0 else mixed(_BYTE_VALUE + _U(seed))
    i = 0
    while i < len(start):
        origin = start[i]
        j = int(np.searchsorted(end, origin + _BLOCK, side="right"))
        if j <= i:  # one span longer than a block
            out[i] = _long_hash(data[origin : end[i]], value)
            i += 1
            continue
        part = value[data[origin : end[j - 1]]] * _UP[: end[j - 1] - origin]
        total = np.zeros(len(part) + 1, _U)
        np.cumsum(part, out=total[1:])
        s, e = start[i:j] - origin, end[i:j] - origin
        out[i:j] = (total[e] - total[s]) * _DOWN[s] + (end[i:j] - start[i:j]).astype(_U)
        i = j
    return mixed(out)


def _long_hash(data: np.ndarray, value: np.ndarray) -> int:
    total, scale = 0, 1
    for k in range(0, len(data), _BLOCK):
        part = data[k : k + _BLOCK]
        total += int((value[part] * _UP[: len(part)]).sum(dtype=_U)) * scale
        scale = scale * pow(_BASE, len(part), 1 << 64) % (1 << 64)
    return (total + len(data)) % (1 << 64)


def gram_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``n`` consecutive word hashes (across rows too: cut with ``grams_inside``)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, _U)
    total = np.zeros(m, _U)
    step = _U(0xD6E8FEB86659FD93 + 2 * seed)
    for k in range(n):
        total *= step
        total += words[k : k + m]
    return mixed(total)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of every range, one range after the other."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - before, counts)
