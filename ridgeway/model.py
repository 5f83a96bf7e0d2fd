"""Model value object and its table form.

A model is ``coef`` (K x d) plus ``intercept`` (K); binary and regression
models have K = 1.  Its table form is the long schema
``class_idx int, feature_idx int, weight double`` where ``feature_idx`` 0 is
the intercept and ``feature_idx`` j >= 1 is ``coef[:, j-1]``.  Only this
K*(d+1)-cell object is ever moved to or from the driver, and every move is
size-checked against :data:`MAX_MODEL_CELLS`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The bound on a model that the driver may hold: a larger one raises (operators.blocked trains
# and scores with a model that stays a table).  32 MB of doubles; raise it with the driver's memory.
MAX_MODEL_CELLS = 4_000_000

MODEL_SCHEMA = T.StructType([
    T.StructField("class_idx", T.IntegerType(), False),
    T.StructField("feature_idx", T.IntegerType(), False),
    T.StructField("weight", T.DoubleType(), False),
])


@dataclass
class LinearModel:
    coef: np.ndarray        # (K, d)
    intercept: np.ndarray   # (K,)

    def __post_init__(self) -> None:
        self.coef = np.atleast_2d(np.asarray(self.coef, dtype=np.float64))
        self.intercept = np.asarray(self.intercept, dtype=np.float64).reshape(-1)
        if self.coef.shape[0] != self.intercept.shape[0]:
            raise ValueError("coef rows and intercept length differ")

    # ---- constructors -------------------------------------------------
    @classmethod
    def zeros(cls, n_classes: int, n_features: int) -> "LinearModel":
        return cls(np.zeros((n_classes, n_features)), np.zeros(n_classes))

    @classmethod
    def from_vector(cls, w) -> "LinearModel":
        """Single-output model from ``[w0 (intercept), w1, ..., wd]``."""
        w = np.asarray(w, dtype=np.float64)
        return cls(w[1:].reshape(1, -1), w[:1])

    @classmethod
    def from_flat(cls, flat, n_classes: int, n_features: int) -> "LinearModel":
        """From the row-major ``K x (d+1)`` layout (intercept first per class)."""
        m = np.asarray(flat, dtype=np.float64).reshape(n_classes, n_features + 1)
        return cls(m[:, 1:], m[:, 0])

    @classmethod
    def from_table(cls, df: DataFrame) -> "LinearModel":
        """Collect a long model table into a model, in one job.  The limit is a
        guard, not a cap: a table over :data:`MAX_MODEL_CELLS` raises."""
        rows = df.select("class_idx", "feature_idx", "weight").limit(MAX_MODEL_CELLS + 1).collect()
        if len(rows) > MAX_MODEL_CELLS:
            raise ValueError("model table is over the driver limit")
        if not rows:
            raise ValueError("empty model table")
        k = max(r[0] for r in rows) + 1
        d = max(r[1] for r in rows)
        if len(rows) != k * (d + 1) or len({(r[0], r[1]) for r in rows}) != len(rows):
            raise ValueError(f"model table is not dense: {len(rows)} cells for K={k}, d={d}")
        flat = np.zeros((k, d + 1))
        for c, j, w in rows:
            flat[c, j] = w
        return cls(flat[:, 1:], flat[:, 0])

    # ---- views --------------------------------------------------------
    @property
    def n_classes(self) -> int:
        return self.coef.shape[0]

    @property
    def n_features(self) -> int:
        return self.coef.shape[1]

    def flat(self) -> np.ndarray:
        """Row-major ``K x (d+1)``, intercept first in each row."""
        return np.hstack([self.intercept.reshape(-1, 1), self.coef]).reshape(-1)

    def vector(self) -> np.ndarray:
        """``[w0, w1..wd]`` of a single-output model."""
        if self.n_classes != 1:
            raise ValueError("vector() needs a single-output model")
        return self.flat()

    def delta_norm(self, other: "LinearModel") -> float:
        """sqrt(||dW||_F^2 + ||db||^2) between two models (A8)."""
        dc = self.coef - other.coef
        di = self.intercept - other.intercept
        return float(np.sqrt(np.sum(dc * dc) + np.sum(di * di)))

    def copy(self) -> "LinearModel":
        return LinearModel(self.coef.copy(), self.intercept.copy())

    def to_table(self, spark: SparkSession, epoch: int | None = None) -> DataFrame:
        k, d = self.coef.shape
        if k * (d + 1) > MAX_MODEL_CELLS:
            raise ValueError("model too large to build on the driver")
        flat = self.flat().reshape(k, d + 1)
        rows = [(int(c), int(j), float(flat[c, j])) for c in range(k) for j in range(d + 1)]
        df = spark.createDataFrame(rows, MODEL_SCHEMA)
        if epoch is not None:
            df = df.withColumn("epoch", F.lit(int(epoch)))
        return df
