"""Vectors as rows of integers: which take part, how they are scaled and packed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 256
LARGEST = 1 << 27
"""Scaled components beyond this would give squared distances of 64 components that no long holds."""


def finite(vector: str) -> Column:
    """Whether no component is null, NaN or infinite."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def integers(column: pa.Array, size: int) -> np.ndarray:
    """floor(256 * x) of the components, as double, one row per vector of ``size`` components."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.floor(SCALE * flat).reshape(-1, size)
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST // SCALE} gives distances beyond 64 bits")
    return out.astype(np.int64)


def packed(rows: np.ndarray) -> pa.Array:
    """One binary of little-endian 32-bit integers per row."""
    width = rows.shape[1] * 4
    data = pa.py_buffer(np.ascontiguousarray(rows.astype("<i4")).tobytes())
    offsets = pa.py_buffer((np.arange(len(rows) + 1, dtype=np.int32) * width).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, data])


def unpacked(column: pa.Array, size: int) -> np.ndarray:
    """Rows of `packed`."""
    if not len(column):
        return np.zeros((0, size), np.int32)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    begin, end = int(offsets[0]), int(offsets[-1])
    return np.frombuffer(column.buffers()[2], "<i4", (end - begin) // 4, begin).reshape(-1, size)
