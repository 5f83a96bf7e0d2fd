"""Adding the tasks' result arrays: fixed-size chunks, added elementwise in two levels.

A task that has folded its rows into one array emits it as rows ``(chunk, bucket, values)`` of at most
``CHUNK`` numbers, so the exchange carries tasks x chunks rows however long the array is.  Level one adds the
chunks of a bucket (one of about sqrt(tasks)) in numpy, level two adds the buckets on the driver, which holds
buckets x size numbers.  While tasks x size is small the first level is left out: one stage less, the same sum.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 4096
SCHEMA = "chunk int, bucket int, values array<double>"

# Up to this many (task x cell) values the driver adds the tasks' chunks itself (plan only).
DIRECT_VALUES = 1_000_000


def buckets(tasks: int) -> int:
    return max(1, math.isqrt(max(0, tasks - 1)) + 1)


def rows(values: np.ndarray, bucket: int) -> pa.RecordBatch:
    """One array as chunk rows."""
    values = np.ascontiguousarray(values, dtype=np.float64).reshape(-1)
    cuts = np.arange(0, len(values), CHUNK, dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(values)), pa.int32()), pa.array(values))
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(cuts), dtype=np.int32)),
                                       pa.array(np.full(len(cuts), bucket, dtype=np.int32)), lists],
                                      names=["chunk", "bucket", "values"])


def task_bucket(n_buckets: int) -> int:
    from pyspark import TaskContext
    ctx = TaskContext.get()
    return (ctx.partitionId() if ctx else 0) % n_buckets


def _add(batches):
    sums: dict[tuple[int, int], np.ndarray] = {}
    for rb in batches:
        for c, b, v in zip(rb.column("chunk").to_pylist(), rb.column("bucket").to_pylist(), rb.column("values")):
            v = v.values.to_numpy()
            if (c, b) in sums:
                sums[c, b] += v
            else:
                sums[c, b] = v.copy()
    for (c, b), v in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([c], pa.int32()), pa.array([b], pa.int32()),
             pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v))],
            names=["chunk", "bucket", "values"])


def total(parts: DataFrame, size: int, tasks: int) -> np.ndarray:
    """The elementwise sum of the tasks' arrays (zeros when no task emitted one)."""
    if tasks * size > DIRECT_VALUES:
        n = min(tasks, buckets(tasks) * max(1, -(-size // CHUNK)))
        parts = parts.repartition(n, F.col("chunk"), F.col("bucket")).mapInArrow(_add, SCHEMA)
    out = np.zeros(size)
    for c, v in _chunks(parts):
        out[c * CHUNK:c * CHUNK + len(v)] += v
    return out


def _chunks(parts: DataFrame):
    """(chunk, numbers) of the collected rows, in a fixed order so that the sum does not depend on arrival."""
    table = parts.toArrow()
    got = [(c, b, v.values.to_numpy()) for c, b, v in zip(table["chunk"].to_pylist(), table["bucket"].to_pylist(), table["values"])]
    return [(c, v) for c, _, v in sorted(got, key=lambda t: t[:2])]
