"""Vectors of a batch as matrices of integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries of one work matrix, so that long vectors come in fewer rows.
ENTRIES = 1 << 20


def _whole(column: pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def lengths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(_whole(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def scaled(column: pa.Array, scale: float, width: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows take part, and floor(scale * entry) of those rows, 0 beyond a vector's end.

    A row takes no part if its vector is null, holds a null or a non-finite entry,
    or one that reaches 2**bits after scaling.
    """
    column = _whole(column)
    size = lengths(column)
    flat = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        flat = np.floor(flat * scale)
        bad = ~(np.abs(flat) < 2.0**bits)
    at = np.concatenate([[0], np.cumsum(size)])
    seen = np.concatenate([[0], np.cumsum(bad)])
    ok = pc.is_valid(column).to_numpy(zero_copy_only=False) & (seen[at[1:]] == seen[at[:-1]])
    if width and (size == width).all():
        return ok, flat.reshape(-1, width)[ok].astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out = np.zeros((len(size), width))
    inside = ok[row]
    out[row[inside], (np.arange(len(flat)) - at[row])[inside]] = flat[inside]
    return ok, out[ok].astype(np.int64)


def parts(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ENTRIES vector entries."""
    step = max(1, ENTRIES // max(width, 1))
    for lo in range(0, batch.num_rows, step):
        yield batch.slice(lo, step)
