"""Vector columns as numpy matrices and as packed bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F


def usable(column: str):
    """Vectors that are neither NULL nor empty and hold only finite numbers."""
    v = F.col(column)
    return F.coalesce((F.size(v) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))),
        F.lit(False))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column whose lists all have ``size`` numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def unpack(column: pa.Array, dtype) -> np.ndarray:
    """Rows of a binary column whose values all have one size."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def pack(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    return pa.array([row.tobytes() for row in np.ascontiguousarray(rows)], pa.binary())
