"""Vectorised text kernels that run inside Arrow batches.

A batch of texts is one byte buffer with offsets.  Words are runs of bytes other
than space and 0x09-0x0D; every function works on the whole buffer at once and
on whole texts.  Work arrays cover about a megabyte of text at a time, so one
very long text costs some bytes for each of its words, not for each byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPAN = 1 << 20
_ODD = 0x9E3779B97F4A7C15 | 1
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _letters(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SPAN + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[at[0] : at[-1]], at - at[0]


def slices(buf: np.ndarray, at: np.ndarray, limit: int = SPAN) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about `limit` bytes each: first row, end row, bytes, offsets."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, buf[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def word_spans(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, end byte and row of each word; a word never crosses rows."""
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def row_counts(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Flagged bytes of each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def count_words(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words of each row, without their positions."""
    first = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[at] = True
    before = ~first[:-1] | edge[1 : len(buf)]
    first[1:] &= before
    return row_counts(first, at)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans are in order of position."""
    out = np.empty(len(starts), np.uint64)
    letters = _letters(seed)
    lo = 0
    while lo < len(starts):
        base = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + SPAN, "right")))
        up, down = powers(int(ends[hi - 1] - base) + 1)
        total = np.zeros(int(ends[hi - 1] - base) + 1, np.uint64)
        np.cumsum(letters[buf[base : ends[hi - 1]]] * up[:-1], out=total[1:])
        s, e = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def run_hashes(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive values, by its first index."""
    count = len(values) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(count, np.uint64)
    for lo in range(0, count, SPAN):
        hi = min(lo + SPAN, count)
        part = values[lo : hi + n - 1]
        up, down = powers(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[:-1], out=total[1:])
        k = hi - lo
        out[lo:hi] = mix((total[n : n + k] - total[:k]) * down[:k])
    return out


def within(rows: np.ndarray, n: int) -> np.ndarray:
    """For each run of n consecutive words, whether it stays in one row."""
    if len(rows) < n:
        return np.zeros(0, bool)
    return rows[: len(rows) - n + 1] == rows[n - 1 :]


def covered(flags: np.ndarray, n: int, size: int) -> np.ndarray:
    """Items that lie in a run of n items whose first index is flagged."""
    depth = np.zeros(size + 1, np.int32)
    hits = np.flatnonzero(flags)
    np.add.at(depth, hits, 1)
    np.add.at(depth, hits + n, -1)
    return np.cumsum(depth)[:size] > 0


def per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the values of each row's items, as int64."""
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def windowed_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` consecutive values, by doubling."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out
