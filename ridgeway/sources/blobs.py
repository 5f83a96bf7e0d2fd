"""Labelled blob points (the reference's synthetic 2-D class clouds), re-aimed.

Instead of a driver-side random matrix, every row of a keyed input table
becomes one point: its class is ``pmod(id, C)`` and each coordinate is
``scale_c * u + offset_c`` with ``u`` in [0, 1) from an integer rule on the
key.  The result is deterministic, grows with the input table, and needs no
driver data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per-class box (scale, offset, label) of the reference's
# examples; coordinates are scale * uniform + offset.
TWO_BLOBS = [(5.0, -3.0, -1.0), (6.0, 7.0, 1.0)]
THREE_BLOBS = [(5.0, -3.0, 0.0), (6.0, 7.0, 1.0), (25.0, 20.0, 2.0)]

# Integer rule for the pseudo-uniform coordinates (recomputable in SQL).
UNIFORM_PRIME = 1000003
UNIFORM_MULTIPLIERS = [7919, 104729, 1299709, 15485863]


def unit_uniform(key: Column, dim: int) -> Column:
    """A [0, 1) value from integer arithmetic on ``key`` (same in any engine)."""
    a = UNIFORM_MULTIPLIERS[dim % len(UNIFORM_MULTIPLIERS)]
    r = F.pmod(F.pmod(key, F.lit(UNIFORM_PRIME)) * F.lit(a) + F.lit(dim * 31 + 17), F.lit(UNIFORM_PRIME))  # inside int64 for any key
    return r.cast("double") / F.lit(float(UNIFORM_PRIME))


def blob_table(keys: DataFrame, id_col: str = "id",
               boxes: Sequence[tuple[float, float, float]] = TWO_BLOBS,
               n_dims: int = 2) -> DataFrame:
    key = F.col(id_col)
    cls = F.pmod(key, F.lit(len(boxes)))

    def per_class(values: Sequence[float]) -> Column:
        expr = F.lit(float(values[-1]))
        for c in range(len(values) - 1):
            expr = F.when(cls == F.lit(c), F.lit(float(values[c]))).otherwise(expr)
        return expr

    scale = per_class([b[0] for b in boxes])
    offset = per_class([b[1] for b in boxes])
    label = per_class([b[2] for b in boxes])
    coords = [(scale * unit_uniform(key, j) + offset).alias(f"x{j + 1}") for j in range(n_dims)]
    return keys.select(key.alias("id"), *coords, label.alias("y"))


def union_class_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Row concatenation of per-class tables (union all, by column name)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
