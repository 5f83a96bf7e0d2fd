"""Whole-number vectors as Arrow batches: shared by the operators on embeddings."""

from __future__ import annotations

import decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries from here on are refused: their products could not be summed exactly in the column types used.
LIMIT = 2.0 ** 40


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    # NaN is larger than any number for Spark, so one comparison a side finds it too
    return F.coalesce(F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False))), F.lit(False))


def whole(vector: Column, factor: int) -> Column:
    """floor(factor * c) of every entry c, as long."""
    def entry(c):
        y = F.floor(c.cast("double") * F.lit(float(factor)))
        too_far = F.abs(c.cast("double") * F.lit(float(factor))) >= F.lit(LIMIT)
        return F.when(too_far, F.raise_error(F.lit("a vector entry is too large for exact sums")).cast("long")).otherwise(y)
    return F.transform(vector, entry)


def matrix(column: pa.Array, d: int) -> np.ndarray:
    """The rows of a list<long> column as an n x d matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def listed(m: np.ndarray) -> pa.ListArray:
    """A matrix as a list column."""
    n, d = m.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(np.ascontiguousarray(m).reshape(-1)))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a' b of whole-number matrices, exact: in floats where every partial sum is below 2^53 (numpy multiplies those
    fastest), else in Python's integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * len(a)
    if top < 2.0 ** 53:
        return np.rint(a.astype(np.float64).T @ b.astype(np.float64)).astype(np.int64).astype(object)
    return a.T.astype(object) @ b.astype(object)


CELLS = "cell int, value decimal(38,0)"


def cells(values) -> pa.RecordBatch:
    """(cell, value) rows of a task's exact sums."""
    amounts = pa.array([decimal.Decimal(int(v)) for v in values], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(amounts), dtype=np.int32)), amounts], names=["cell", "value"])


def total(partials: DataFrame, size: int) -> list[int]:
    """The sums of the tasks' cells, as Python integers (``size`` numbers reach the driver)."""
    out = [0] * size
    for row in partials.groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[row["cell"]] = int(row["value"])
    return out
