"""Vectors between Arrow list columns and NumPy matrices, inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equally long lists as a matrix."""
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks])
    return flat.reshape(len(column), -1)


def lists(rows: np.ndarray) -> pa.Array:
    """A matrix as a column of lists."""
    n, dim = rows.shape
    offsets = np.arange(0, n * dim + 1, dim, dtype=np.int32) if n else np.zeros(1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


def instants(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Microseconds and a mask of the missing ones."""
    missing = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(), missing
