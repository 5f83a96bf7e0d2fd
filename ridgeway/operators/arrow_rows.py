"""Checks that every Arrow function makes before it reads a batch as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def feature_matrix(column: pa.Array, d: int) -> np.ndarray:
    """The rows of a list column as an n x d matrix.  A NULL row, a NULL or NaN value or a
    row of another length raises: only the total length would let neighbours shift."""
    n = len(column)
    if column.null_count:
        raise ValueError("NULL or NaN in features or label")
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if n and (lengths != d).any():
        raise ValueError(f"feature rows must all have length {d}")
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("NULL or NaN in features or label")
    X = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, d)
    if np.isnan(X).any():
        raise ValueError("NULL or NaN in features or label")
    return X


def labels(column: pa.Array, kind: str | None = None, n_classes: int | None = None) -> np.ndarray:
    """The labels of a batch; with ``kind`` they must be -1 or 1 (hinge) or whole numbers in 0..K-1."""
    y = column.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if column.null_count or np.isnan(y).any():
        raise ValueError("NULL or NaN in features or label")
    if kind == "hinge":
        if (np.abs(y) != 1.0).any():
            raise ValueError("hinge labels must be -1 or 1")
    elif kind is not None:
        if (y != np.floor(y)).any():
            raise ValueError("class labels must be whole numbers")
        if (y < 0).any() or (n_classes is not None and (y >= n_classes).any()):
            raise ValueError("class labels must be 0..K-1")
    return y
