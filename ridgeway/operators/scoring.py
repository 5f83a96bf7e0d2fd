"""Scoring operators: decision scores, class scores, probabilities, argmax,
per-row class ranking, accuracy and decision-boundary / margin lines.

Narrow models are inlined as literals (whole-stage codegen, no join).  Wide
K-class models (K*d above ``ARROW_CELLS``) score through ``mapInArrow`` with
one numpy matrix product per Arrow batch; the model travels in the task
closure, bounded by :data:`ridgeway.model.MAX_MODEL_CELLS`.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeway.functions.linear import boundary_coordinate, dot_then_bias, linear_predictor
from ridgeway.functions.multiclass import argmax, class_scores, softmax
from ridgeway.model import MAX_MODEL_CELLS, LinearModel
from ridgeway.operators.arrow_rows import feature_matrix

ARROW_CELLS = 256


def decision_score(df: DataFrame, features: Sequence[str], model: LinearModel,
                   out: str = "score") -> DataFrame:
    """Raw w.x + b of a single-output model (no sign, no threshold)."""
    return df.withColumn(out, dot_then_bias(features, model.coef[0], model.intercept[0]))


def score_with_model_table(df: DataFrame, features: Sequence[str], model_table: DataFrame,
                           out: str = "z") -> DataFrame:
    """Score rows with a stored model table: the table (d+1 cells, size-checked
    on collection) becomes literals of the projection, so every row sees the
    whole model without any join or shuffle.
    """
    m = LinearModel.from_table(model_table)
    if m.n_features != len(features):
        raise ValueError(f"model has {m.n_features} features, rows have {len(features)}")
    return df.withColumn(out, linear_predictor(features, m.coef[0], m.intercept[0]))


def _arrow_scores(df: DataFrame, features: str, model: LinearModel, out: str) -> DataFrame:
    W, b = model.coef.copy(), model.intercept.copy()
    d = model.n_features
    schema = T.StructType(df.schema.fields + [T.StructField(out, T.ArrayType(T.DoubleType(), False), True)])

    def run(batches):
        for rb in batches:
            S = feature_matrix(rb.column(features), d) @ W.T + b
            scores = pa.FixedSizeListArray.from_arrays(pa.array(S.reshape(-1)), S.shape[1])
            scores = scores.cast(pa.list_(pa.field("element", pa.float64(), nullable=False)))
            yield pa.RecordBatch.from_arrays(list(rb.columns) + [scores],
                                             names=list(rb.schema.names) + [out])

    return df.mapInArrow(run, schema)


def with_class_scores(df: DataFrame, features: str, model: LinearModel, out: str = "scores",
                      method: str = "auto") -> DataFrame:
    cells = model.n_classes * model.n_features
    if cells > MAX_MODEL_CELLS:
        raise ValueError("model too large to ship with the scoring tasks")
    if method == "arrow" or (method == "auto" and cells > ARROW_CELLS):
        return _arrow_scores(df, features, model, out)
    # the same checks as the Arrow path makes
    x = F.col(features)
    good = x.isNotNull() & (F.size(x) == model.n_features) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v))
    why = F.raise_error(F.lit(f"feature rows must all have length {model.n_features} without NULL or NaN"))
    return df.withColumn(out, F.when(F.coalesce(good, F.lit(False)), class_scores(features, model)).otherwise(why.cast("array<double>")))


def with_probabilities(df: DataFrame, scores: str = "scores", out: str = "probs") -> DataFrame:
    return df.withColumn(out, softmax(scores))


def with_prediction(df: DataFrame, scores: str = "scores", out: str = "prediction") -> DataFrame:
    return df.withColumn(out, argmax(scores))


def ranked_classes(df: DataFrame, id_col: str, scores: str = "scores") -> DataFrame:
    """Long form ``id, class_idx, score, class_rank`` with rank 1 = predicted class
    (score descending, ties to the lower class index).  Ranking happens inside
    each row's own array (``array_sort``), so no shuffle by id is needed.
    """
    pairs = F.transform(F.col(scores), lambda s, k: F.struct(s.alias("score"), k.alias("class_idx")))
    ranked = F.array_sort(pairs, lambda a, b: F.when(a["score"] > b["score"], F.lit(-1))
                          .when(a["score"] < b["score"], F.lit(1))
                          .when(a["class_idx"] < b["class_idx"], F.lit(-1))
                          .when(a["class_idx"] > b["class_idx"], F.lit(1))
                          .otherwise(F.lit(0)))
    return (df.select(F.col(id_col), F.posexplode(ranked).alias("pos", "c"))
              .select(F.col(id_col), F.col("c.class_idx").cast("int").alias("class_idx"),
                      F.col("c.score").alias("score"),
                      (F.col("pos") + F.lit(1)).cast("int").alias("class_rank")))


def accuracy(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.avg((F.col(prediction) == F.col(label)).cast("double")).alias("accuracy"))


def boundary_lines(df: DataFrame, features: Sequence[str], model: LinearModel,
                   offsets: dict[str, float]) -> DataFrame:
    """Last-feature coordinates of the lines w.x + b = offset (NULL when w_d == 0)."""
    cols = [boundary_coordinate(features, model.coef[0], model.intercept[0], off).alias(name)
            for name, off in offsets.items()]
    return df.select("*", *cols)
