"""Quality classifier: random Fourier features, ridge normal equations, isotonic calibration.

Each text gives ``len(FEATURES)`` statistics.  They are standardised (mean and deviation over all
documents, cut at +-4) and mapped to ``dimension`` random cosines, whose inner products
approximate a Gaussian kernel of width ``width * sqrt(features)``.  Labelled rows of the fitting
folds are summed by partition into the normal equations, of which only (dimension + 1)^2 / 2 + dimension
numbers reach the driver; ridge solves them.  The raw scores of the labelled rows of another fold,
counted in ``BINS`` bins, are calibrated by isotonic regression (pool adjacent violators); scores
between the bins' means are interpolated, so the result rises with the raw score, from 0 to 1.

Folds are ``crc32(id as text) mod 5``: 0 is never learned from, 4 calibrates, the others fit.  Neither id,
label, source nor language is a feature.

Defined cases: null text is empty; an empty text has statistics of 0 and a score like any other; null ids
are in fold 0; labels that are null or without document are left out, of repeated labels the
largest counts; without any label of the fitting folds every score is 0.5; repeated rows are scored one
by one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import Shared, slices, texts_of
from ridgeway.llm.divergence import base_counts, class_counts
from ridgeway.llm.graph import store

FEATURES = ("lower", "upper", "digit", "space", "stop", "symbol", "other", "wide", "log_words", "word_length",
            "distinct_words", "repeat_words", "dup_lines", "line_length", "top_word", "shout")
DIMENSION, WIDTH, RIDGE, BINS, SEED = 192, 0.7, 1.0, 2000, 11
FIT_FOLDS, CALIBRATION_FOLD, THRESHOLD = (1, 2, 3), 4, 0.3


def statistics(text: bytes) -> np.ndarray:
    """The features of one text."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(len(FEATURES))
    counts = class_counts(text)
    total, chars, _, dup, repeat = base_counts(text)
    lines = text.count(b"\n") + 1
    times = Counter(words)
    distinct, top = len(times), max(times.values()) / n
    shout = sum(k for w, k in times.items() if w.isupper() and len(w) > 1) / n
    return np.array([*(counts / counts.sum()), np.log1p(n), min(chars / n, 20.0), distinct / n ** 0.85, repeat / n, dup / lines,
                     np.log1p(n / lines), top, shout])


def fold(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(5)), F.lit(0)).cast("int")


class Kernel:
    """Standardisation and random cosines; picklable."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, dimension: int = DIMENSION, width: float = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, np.where(deviation > 1e-9, deviation, 1.0)
        self.w = rng.standard_normal((len(mean), dimension)) / (width * np.sqrt(len(mean)))
        self.b = rng.uniform(0, 2 * np.pi, dimension)

    def map(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -4, 4)
        return np.hstack([np.sqrt(2 / len(self.b)) * np.cos(x @ self.w + self.b), np.ones((len(x), 1))])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators on points ordered by x: (mean x, value) of the pools."""
    pools: list[list[float]] = []
    for a, b, w in zip(x, y, weight):
        pools.append([a * w, b * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    s = np.array(pools)
    return s[:, 0] / s[:, 2], s[:, 1] / s[:, 2]


class Model:
    def __init__(self, kernel: Kernel, weights: np.ndarray, x: np.ndarray, y: np.ndarray):
        self.kernel, self.weights, self.x, self.y = kernel, weights, x, y

    def raw(self, features: np.ndarray) -> np.ndarray:
        return self.kernel.map(features) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(features), self.x, self.y), 0.0, 1.0)


def _matrix(batch) -> np.ndarray:
    return batch.column("features").flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))


def featurise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fold, features) per row, as a table in the shared folder: texts are read once."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), fold(id_col).alias("fold"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        for batch in slices(batches):
            rows = [statistics(t) for t in texts_of(batch.column("text"))]
            flat = np.concatenate(rows) if rows else np.zeros(0)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("fold"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                                             names=["id", "fold", "features"])

    return store(src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, fold int, features array<double>"), "features")


def _sums(shared, dimension: int):
    """Per partition: the upper triangle of Z'Z, and Z'y, as (cell, value) rows."""
    def run(batches):
        kernel, a, b = shared.value, np.zeros((dimension + 1, dimension + 1)), np.zeros(dimension + 1)
        for batch in batches:
            z = kernel.map(_matrix(batch))
            a += z.T @ z
            b += z.T @ batch.column("label").to_numpy()
        values = np.concatenate([a[np.triu_indices(dimension + 1)], b])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["cell", "value"])
    return run


def fit(features: DataFrame, labels: DataFrame, *, label_col: str = "quality", label_id_col: str = "doc_id",
        dimension: int = DIMENSION, width: float = WIDTH, ridge: float = RIDGE, seed: int = SEED) -> Model:
    """Learns from labelled rows whose fold is not 0."""
    spark = features.sparkSession
    moments = features.select(*[F.col("features")[k].alias(f"f{k}") for k in range(len(FEATURES))])
    row = moments.agg(*[f(f"f{k}") for k in range(len(FEATURES)) for f in (F.avg, F.stddev_pop)]).first()
    stats = np.array([0.0 if v is None else v for v in row]).reshape(-1, 2)
    kernel = Kernel(stats[:, 0], stats[:, 1], dimension, width, seed)
    told = (labels.select(F.col(f"`{label_id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label")).where("label is not null")
            .groupBy("id").agg(F.max("label").alias("label")))
    known = features.where("fold > 0").join(told, "id")
    shared = Shared(spark, kernel)
    cells = (known.where(F.col("fold").isin(*FIT_FOLDS)).select("features", "label").mapInArrow(_sums(shared, dimension), "cell int, value double")
             .groupBy("cell").agg(F.sum("value").alias("value")).toPandas().sort_values("cell")["value"].to_numpy())
    n = dimension + 1
    if not len(cells) or not np.any(cells):
        return Model(kernel, np.zeros(n), np.zeros(1), np.full(1, 0.5))
    upper = np.zeros((n, n))
    upper[np.triu_indices(n)] = cells[:-n]
    full = upper + np.triu(upper, 1).T
    weights = np.linalg.solve(full + ridge * np.diag([1.0] * dimension + [1e-6]), cells[-n:])
    model = Shared(spark, Model(kernel, weights, np.zeros(1), np.zeros(1)))

    def raw(batches):
        m = model.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.clip(np.floor(m.raw(_matrix(batch)) * BINS / 2), -BINS, 2 * BINS).astype(np.int32)),
                                              batch.column("label")], names=["bin", "label"])

    bins = (known.where(F.col("fold") == CALIBRATION_FOLD).select("features", "label").mapInArrow(raw, "bin int, label double")
            .groupBy("bin").agg(F.avg("label").alias("y"), F.count("*").alias("n")).toPandas().sort_values("bin"))
    if not len(bins):
        return Model(kernel, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    x, y = isotonic((bins["bin"].to_numpy() + 0.5) * 2 / BINS, bins["y"].to_numpy(), bins["n"].to_numpy(dtype=float))
    return Model(kernel, weights, x, y)


def score(features: DataFrame, model: Model, *, id_col: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``featurise``: id, held_out, score, predicted."""
    shared = Shared(features.sparkSession, model)

    def run(batches):
        m = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("fold"), pa.array(m.score(_matrix(batch)))], names=["id", "fold", "score"])

    made = features.mapInArrow(run, f"id {features.schema['id'].dataType.simpleString()}, fold int, score double")
    return made.select(F.col("id").alias(id_col), (F.col("fold") == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
