"""Full-batch gradient, loss and step operators (single-output models).

All statistics of an epoch -- row count, loss sum and the d+1 gradient sums --
come out of ONE ungrouped aggregate: each task keeps d+3 running sums
(partial aggregate) and a single final task adds one row per input
partition, so the shuffle is ``partitions x (d+3)`` doubles regardless of
data size.  Weights enter as literals and the per-row terms are computed once
in a projection fused into the same codegen stage as the Parquet scan.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeway.functions.linear import linear_predictor, logistic_nll, sigmoid
from ridgeway.model import MAX_MODEL_CELLS
from ridgeway.operators import array_sum
from ridgeway.operators.arrow_rows import feature_matrix, labels

LOSSES = ("squared", "logistic")


def _terms(rows: DataFrame, features: Sequence[str], label: str, w: Sequence[float],
           loss: str, weight: str | None = None, more: Sequence[Column] = ()) -> DataFrame:
    """Per-row ``diff`` (the gradient factor) and ``loss_term`` next to the features (and ``more``);
    with ``weight`` (a row multiplicity) both are multiplied by it."""
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    z = linear_predictor(features, w[1:], w[0])
    y = F.col(label)
    keep = [*features] + ([weight] if weight else [])
    if loss == "squared":
        # (z - y)^2 written on the same z so codegen evaluates it once per row
        t = rows.select(*keep, *more, (z - y).alias("diff")).withColumn("loss_term", F.col("diff") * F.col("diff"))
    else:
        t = rows.select(*keep, *more, y.alias("_y"), z.alias("_z")).select(
            "*", (sigmoid("_z") - F.col("_y")).alias("diff"),
            logistic_nll("_z", "_y").alias("loss_term"))
    if weight:
        c = F.col(weight).cast("double")
        t = t.select(*features, weight, (F.col("diff") * c).alias("diff"),
                     (F.col("loss_term") * c).alias("loss_term"))
    return t


def gradient_stats(rows: DataFrame, features: Sequence[str], label: str,
                   w: Sequence[float], loss: str, weight: str | None = None, distinct: bool = False) -> DataFrame:
    """One row: ``n_rows, loss_sum, g0..gd`` with g0 = sum(diff), gi = sum(diff*xi).

    ``weight`` names a multiplicity column (rows grouped by identical features and
    label): the sums are the same as over the ungrouped rows.  ``n_valid`` counts
    the (grouped) rows whose terms are neither NULL nor NaN; ``n_groups`` counts (grouped) rows.
    With ``distinct`` the same pass estimates ``n_distinct`` (features, label) rows (HyperLogLog).
    """
    key = F.struct(*[F.col(c) for c in [*features, label]]).alias("_key")
    t = _terms(rows, features, label, w, loss, weight, [key] if distinct else [])
    n = F.sum(weight).cast("long") if weight else F.count(F.lit(1))
    aggs = [n.alias("n_rows"), F.count(F.lit(1)).alias("n_groups"), F.count(F.when(F.col("diff").isNotNull() & ~F.isnan("diff"), F.lit(1))).alias("n_valid"),
            F.sum("loss_term").alias("loss_sum"), F.sum("diff").alias("g0")]
    aggs += [F.sum(F.col("diff") * F.col(x)).alias(f"g{i}") for i, x in enumerate(features, 1)]
    if distinct:
        aggs.append(F.approx_count_distinct("_key", 0.05).alias("n_distinct"))
    return t.agg(*aggs)


# A grouped table estimated at most this large is kept in ONE partition, so each
# epoch's aggregate needs no exchange (one stage).  The grouping itself runs in as many
# tasks as any aggregate; only its result moves.
SINGLE_TASK_ROWS = 100_000


def compress_rows(rows: DataFrame, features: Sequence[str], label: str,
                  max_ratio: float, force: bool = False, weight: str = "_mult") -> DataFrame | None:
    """Identical (features, label) rows collapsed to one row with a multiplicity.

    One pass estimates the distinct combinations (HyperLogLog, no data shuffle);
    only when they are at most ``max_ratio`` of the rows (or ``force``) is the
    ``groupBy`` run -- map-side combined, so each task ships at most its distinct
    rows.  Returns None when compression would not pay.  A grouped table
    estimated at <= ``SINGLE_TASK_ROWS`` rows is then moved to one partition.
    """
    k = None
    if not force:
        key = F.struct(*[F.col(c) for c in [*features, label]])
        r = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(key, 0.05).alias("k")).collect()[0]
        if r["n"] == 0 or r["k"] > max_ratio * r["n"]:
            return None
        k = int(r["k"])
    return group_rows(rows, features, label, weight, k)


def group_rows(rows: DataFrame, features: Sequence[str], label: str, weight: str = "_mult",
               k: int | None = None) -> DataFrame:
    """The ``groupBy`` of :func:`compress_rows`, for an estimate ``k`` of its rows."""
    grouped = rows.groupBy(*features, label).agg(F.count(F.lit(1)).alias(weight))
    if k is not None and k <= SINGLE_TASK_ROWS:
        grouped = grouped.repartition(1)
    return grouped


# ---- grouped rows as numpy blocks: epochs without generated code ---------

BLOCK_BYTES = 32 << 20


def gradient_blocks(grouped: DataFrame, features: Sequence[str], label: str, weight: str):
    """Grouped rows as an RDD of blocks (X, y, multiplicity) of about ``BLOCK_BYTES``; NULL and NaN raise."""
    d = len(features)

    def pack(batches):
        pieces, size = [], 0

        def block() -> pa.RecordBatch:
            made = pickle.dumps(tuple(np.concatenate(part) for part in zip(*pieces)), protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["block"])

        for rb in batches:
            if not rb.num_rows:
                continue
            pieces.append((feature_matrix(rb.column("f"), d), labels(rb.column("y")),
                           rb.column("m").to_numpy(zero_copy_only=False).astype(np.float64)))
            size += rb.num_rows * (d + 2) * 8
            if size >= BLOCK_BYTES:
                yield block()
                pieces, size = [], 0
        if pieces:
            yield block()

    src = grouped.select(_feature_array(features).alias("f"), F.col(label).cast("double").alias("y"), F.col(weight).alias("m"))
    return src.mapInArrow(pack, "block binary").rdd.map(lambda r: pickle.loads(r[0]))


def gradient_of_blocks(blocks, w: Sequence[float], loss: str) -> tuple[int, float, np.ndarray]:
    """(n_rows, loss_sum, g) at ``w``.  The weights (d+1 numbers) ride in the task closure, so every epoch runs the
    same code; a task returns d+3 numbers, added on the driver while they are few, else in a tree."""
    w = np.asarray(w, dtype=np.float64)

    def run(parts):
        out, seen = np.zeros(len(w) + 2), False
        for X, y, m in parts:
            z = X @ w[1:] + w[0]
            n, ls, diff = _factors(z, y, loss, m)
            out += np.concatenate([[n, ls, diff.sum()], diff @ X])
            seen = True
        if seen:
            yield out

    sums = blocks.mapPartitions(run)
    if blocks.getNumPartitions() * (len(w) + 2) <= array_sum.DIRECT_VALUES:
        got = sum(sums.collect(), np.zeros(len(w) + 2))
    else:
        got = sums.treeAggregate(np.zeros(len(w) + 2), lambda a, b: a + b, lambda a, b: a + b, depth=2)
    n = int(round(got[0]))
    return n, (float(got[1]) if n else float("nan")), got[2:]


def _factors(z: np.ndarray, y: np.ndarray, loss: str, m=1.0) -> tuple[float, float, np.ndarray]:
    """(rows, loss sum, gradient factors) of a batch whose rows stand ``m`` times each."""
    if loss == "squared":
        diff = z - y
        terms = diff * diff
    else:
        diff = 1.0 / (1.0 + np.exp(-z)) - y
        terms = np.maximum(z, 0.0) + np.log1p(np.exp(-np.abs(z))) - y * z
    return float(np.sum(np.broadcast_to(m, z.shape))), float(np.sum(terms * m)), diff * m


def gradient_table(stats: DataFrame, n_features: int) -> DataFrame:
    """Unpivot a :func:`gradient_stats` row to ``class_idx, feature_idx, grad, n_rows``."""
    cells = [F.struct(F.lit(0).alias("class_idx"), F.lit(i).alias("feature_idx"),
                      F.col(f"g{i}").alias("grad")) for i in range(n_features + 1)]
    return stats.select(F.inline(F.array(*cells)), "n_rows")


def gradient_long_form(rows: DataFrame, features: Sequence[str], label: str,
                       w: Sequence[float], loss: str) -> DataFrame:
    """The unpivot-then-reduce-by-key form: each row emits (feature_idx, term),
    then ``groupBy(feature_idx).sum``.  Partial aggregation keeps the shuffle at
    (d+1) rows per partition.
    """
    t = _terms(rows, features, label, w, loss)
    terms = F.array(F.col("diff"), *[F.col("diff") * F.col(x) for x in features])
    return (t.select(F.posexplode(terms).alias("feature_idx", "term"))
             .groupBy("feature_idx")
             .agg(F.sum("term").alias("grad"), F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(0).alias("class_idx"), F.col("feature_idx").cast("int"), "grad", "n_rows"))


def step_expression(w: Column, grad: Column, n: Column, idx: Column, loss: str,
                    lr: float, l2: float = 0.0) -> Column:
    """One gradient step on one weight cell.

    squared : w0 - 2 lr g0/n ;  wi - (2 lr gi/n + 2 l2 wi)   (decay not scaled by lr)
    logistic: wi - lr gi/n
    """
    lr_, l2_ = F.lit(float(lr)), F.lit(float(l2))
    two = F.lit(2.0)
    if loss == "squared":
        return F.when(idx == F.lit(0), w - two * lr_ * grad / n) \
                .otherwise(w - (two * lr_ * grad / n + two * l2_ * w))
    if l2:
        raise ValueError("the logistic step has no L2 term")
    return w - lr_ * grad / n


def gradient_step_join(grad: DataFrame, model: DataFrame, loss: str, lr: float,
                       l2: float = 0.0, model_cells: int | None = None) -> DataFrame:
    """New weights = old weights joined with their gradient sums on
    ``(class_idx, feature_idx)``.  The model side is broadcast only when its
    cell count is known and bounded; otherwise Spark plans the join itself.
    """
    m = model.select("class_idx", "feature_idx", F.col("weight").alias("w_old"))
    if model_cells is not None and model_cells <= MAX_MODEL_CELLS:
        m = F.broadcast(m)
    j = grad.join(m, ["class_idx", "feature_idx"])
    new_w = step_expression(F.col("w_old"), F.col("grad"), F.col("n_rows"),
                            F.col("feature_idx"), loss, lr, l2)
    return j.select("class_idx", "feature_idx", new_w.alias("weight"))


def l2_penalty(model: DataFrame, lam: float) -> DataFrame:
    """lam * sum of squared weights, intercept (feature_idx 0) excluded."""
    return (model.filter(F.col("feature_idx") >= F.lit(1))
                 .agg((F.lit(float(lam)) * F.coalesce(F.sum(F.col("weight") * F.col("weight")),
                                                       F.lit(0.0))).alias("l2_penalty")))


def loss_summary(rows: DataFrame, features: Sequence[str], label: str, w: Sequence[float]) -> DataFrame:
    """Count, SSE/MSE under squared loss and NLL sum/mean under logistic loss, one pass.

    The logistic part treats ``label`` as 0/1; pass a 0/1 label for it to be meaningful.
    """
    z = linear_predictor(features, w[1:], w[0])
    t = rows.select(F.col(label).alias("_y"), z.alias("_z"))
    t = t.select((F.col("_z") - F.col("_y")).alias("r"), logistic_nll("_z", "_y").alias("nll"))
    return t.agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.col("r") * F.col("r")).alias("sse"),
                 F.avg(F.col("r") * F.col("r")).alias("mse"),
                 F.sum("nll").alias("nll_sum"),
                 F.avg("nll").alias("mean_nll"))


# ---- one-pass sufficient statistics for squared loss (R1) ---------------

# Up to this width the statistics are generated sums in one aggregate; above it (and for array
# columns) each task multiplies its Arrow batches with numpy (plan only: the same sums).
GENERATED_GRAM_FEATURES = 12


def gram_stats(rows: DataFrame, features: Sequence[str] | str, label: str, n_features: int | None = None) -> dict:
    """n, q = sum y^2, h = sum x~ y, G = sum x~ x~^T with x~ = [1, x].

    One scan; (d+1)(d+2)/2 + d + 3 sums cross the network a task.  Every squared-loss
    epoch afterwards is driver arithmetic on (d+1)^2 numbers.
    """
    if isinstance(features, str) or len(features) > GENERATED_GRAM_FEATURES:
        return _gram_stats_arrow(rows, features, label, n_features if isinstance(features, str) else len(features))
    d = len(features)
    xs = [F.lit(1.0)] + [F.col(c) for c in features]
    y = F.col(label)
    valid = y.isNotNull() & ~F.isnan(y)
    for c in features:
        valid = valid & F.col(c).isNotNull() & ~F.isnan(c)
    aggs = [F.count(F.lit(1)).alias("n"), F.count(F.when(valid, F.lit(1))).alias("n_valid"),
            F.sum(y * y).alias("q")]
    aggs += [F.sum(xs[i] * y).alias(f"h{i}") for i in range(d + 1)]
    aggs += [F.sum(xs[i] * xs[j]).alias(f"G{i}_{j}") for i in range(d + 1) for j in range(i, d + 1)]
    r = rows.select(*features, label).agg(*aggs).collect()[0]
    n = int(r["n"])
    if int(r["n_valid"]) != n:
        raise ValueError("NULL or NaN in features or label")
    G = np.zeros((d + 1, d + 1))
    for i in range(d + 1):
        for j in range(i, d + 1):
            v = r[f"G{i}_{j}"]
            G[i, j] = G[j, i] = 0.0 if v is None else v
    h = np.array([0.0 if r[f"h{i}"] is None else r[f"h{i}"] for i in range(d + 1)])
    q = 0.0 if r["q"] is None else float(r["q"])
    return {"n": n, "q": q, "h": h, "G": G}


def _gram_fn(d: int, n_buckets: int):
    """Per task: the upper triangle of Z'Z with Z = [1, x, y], as one array."""
    def run(batches):
        Z2, seen = np.zeros((d + 2, d + 2)), False
        for rb in batches:
            if not rb.num_rows:
                continue
            Z = np.empty((rb.num_rows, d + 2))
            Z[:, 0], Z[:, 1:-1], Z[:, -1] = 1.0, feature_matrix(rb.column("f"), d), labels(rb.column("y"))
            Z2 += Z.T @ Z
            seen = True
        if seen:
            yield array_sum.rows(Z2[np.triu_indices(d + 2)], array_sum.task_bucket(n_buckets))

    return run


def _gram_stats_arrow(rows: DataFrame, features: Sequence[str] | str, label: str, d: int | None) -> dict:
    if d is None:
        raise ValueError("an array feature column needs n_features")
    size = (d + 2) * (d + 3) // 2
    if size > MAX_MODEL_CELLS:
        raise ValueError("too many features for Gram statistics on the driver")
    src = rows.select(_feature_array(features).alias("f"), F.col(label).cast("double").alias("y"))
    tasks = src.rdd.getNumPartitions()
    total = array_sum.total(src.mapInArrow(_gram_fn(d, array_sum.buckets(tasks)), array_sum.SCHEMA), size, tasks)
    Z2 = np.zeros((d + 2, d + 2))
    Z2[np.triu_indices(d + 2)] = total
    Z2 = Z2 + np.triu(Z2, 1).T
    return {"n": int(round(Z2[0, 0])), "q": float(Z2[-1, -1]), "h": Z2[:-1, -1].copy(), "G": Z2[:-1, :-1].copy()}


# ---- wide models: Arrow partial vectors (R3) -----------------------------

def _feature_array(features: Sequence[str] | str) -> Column:
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.array(*[F.col(c) for c in features]).cast("array<double>")


def _partial_gradient_fn(w: np.ndarray, loss: str, n_buckets: int):
    d = len(w) - 1
    b, coef = float(w[0]), np.asarray(w[1:], dtype=np.float64)

    def run(batches):
        g = np.zeros(d + 1)
        n, ls = 0, 0.0
        for rb in batches:
            m = rb.num_rows
            if m == 0:
                continue
            X, y = feature_matrix(rb.column("f"), d), labels(rb.column("y"))
            _, terms, diff = _factors(X @ coef + b, y, loss)
            ls += terms
            g[0] += diff.sum()
            g[1:] += diff @ X
            n += m
        if n:
            yield array_sum.rows(np.concatenate([[float(n), ls], g]), array_sum.task_bucket(n_buckets))

    return run


def gradient_stats_arrow(rows: DataFrame, features: Sequence[str] | str, label: str,
                         w: Sequence[float], loss: str) -> tuple[int, float, np.ndarray]:
    """(n_rows, loss_sum, g) for wide models: each task folds its Arrow batches into
    one (d+3)-vector with numpy, emitted and added as array chunks (operators.array_sum).
    The weights ride in the task closure (size-checked by the caller)."""
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    w = np.asarray(w, dtype=np.float64)
    if len(w) > MAX_MODEL_CELLS:
        raise ValueError("model too large to ship with the gradient tasks")
    src = rows.select(_feature_array(features).alias("f"), F.col(label).cast("double").alias("y"))
    tasks = src.rdd.getNumPartitions()
    parts = src.mapInArrow(_partial_gradient_fn(w, loss, array_sum.buckets(tasks)), array_sum.SCHEMA)
    got = array_sum.total(parts, len(w) + 2, tasks)
    n = int(round(got[0]))
    return n, (float(got[1]) if n else float("nan")), got[2:]
