"""Slices: bounded runs of rows whose distinct keys are looked up elsewhere and come back.

An operator that needs something global for each key of each document (the terms of a
chunk, the count of a pair) cuts its rows into slices, sends the distinct keys of a
slice once, and keeps what the documents need in a row of packed arrays. The answers
meet that row again by the number of the slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def planes(values: np.ndarray, dtype: str = "<u4") -> bytes:
    """Numbers as bytes, all lowest bytes first: small numbers compress well."""
    values = np.ascontiguousarray(values, dtype)
    return values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes()


def from_planes(data: bytes, dtype: str = "<u4") -> np.ndarray:
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(dtype).ravel()


def runs(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.Table]:
    """Rows of a task in tables whose texts in ``column`` have about ``limit`` bytes, or one row."""
    held, size = [], 0
    for batch in batches:
        sizes = text_sizes(batch.column(column))
        row = 0
        while row < batch.num_rows:
            ends = size + np.cumsum(sizes[row:])
            n = int(np.searchsorted(ends, limit, "right"))
            if n < len(ends) and not n and not held:
                n = 1  # longer than a slice alone
            if n:
                held.append(batch.slice(row, n))
                size += int(sizes[row:row + n].sum())
                row += n
            if row < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def text_sizes(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def strings_of(data: np.ndarray | bytes, sizes: np.ndarray) -> pa.Array:
    """A binary array of strings that lie end to end."""
    edges = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    wide = edges[-1] >= 1 << 31
    return pa.Array.from_buffers(
        pa.large_binary() if wide else pa.binary(), len(sizes),
        [None, pa.py_buffer(edges.astype(np.int64 if wide else np.int32)), pa.py_buffer(data)])


def buffers_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array without nulls, end to end, and each size."""
    wide = pa.types.is_large_binary(array.type) or pa.types.is_large_string(array.type)
    edges = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[
        array.offset:array.offset + len(array) + 1].astype(np.int64)
    buffer = array.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[edges[0]:edges[-1]], np.diff(edges)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes of the elements of runs, one run after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def joined(parts: list[np.ndarray], dtype: type) -> np.ndarray:
    return np.concatenate([*parts, np.empty(0, dtype)]).astype(dtype, copy=False)
