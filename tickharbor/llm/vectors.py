"""Columns of vectors as matrices, for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Components of a block of rows that a task works on at once.
BLOCK_VALUES = 1 << 20


def width(vectors: DataFrame, column: str) -> int:
    """Components of the longest vector; shorter ones count as filled up with zeros."""
    return vectors.agg(F.max(F.size(F.col(column)))).first()[0] or 0


def row_key() -> Column:
    """A number of the row's own, for tables that are stored with it."""
    return F.monotonically_increasing_id()


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of rows whose matrices stay small."""
    rows = max(1, BLOCK_VALUES // max(size, 1))
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def matrix(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows as doubles, and which of them are whole: neither null nor with a null or non-finite component."""
    lists = column.cast(pa.list_(pa.float64()))
    values = np.zeros((len(lists), size))
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)  # a null component becomes NaN
    if len(flat):
        own = np.repeat(np.arange(len(lists)), lengths)
        values[own, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    whole = np.asarray(lists.is_valid()) & np.isfinite(values).all(axis=1)
    return np.where(whole[:, None], values, 0.0), whole


def packed(values: np.ndarray) -> pa.Array:
    """One binary value per row of a matrix."""
    step = values.shape[1] * values.dtype.itemsize
    ends = np.arange(len(values) + 1, dtype=np.int64) * step
    return pa.Array.from_buffers(pa.large_binary(), len(values), [
        None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, size: int, kind: type = np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), size)
