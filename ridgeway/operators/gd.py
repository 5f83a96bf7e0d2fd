"""Full-batch gradient descent trainers (linear with L2, logistic).

The loop lives on the driver and only ever holds d+1 weights.  Each epoch:

1. evaluate count, loss and gradient at the current weights (one aggregate,
   or -- for squared loss -- driver arithmetic on one-pass Gram statistics);
2. loss = mean loss (+ l2 * sum_{i>=1} w_i^2 for the linear model);
3. continue iff ``prev_loss - loss > tol`` (covers both stop tests of the
   reference for tol >= 0, including inf/NaN losses, which stop);
4. on continue take one step, otherwise return the weights just evaluated
   (no step on the stopping epoch).

With squared loss, no L2 term and no epoch limit the epochs after the one Gram pass need no loop at all: an epoch is an affine map of
the weights, its powers come by repeated squaring, and the loss falls by ever smaller steps, so the
epoch at which the stop test holds is found by bisection (:func:`stopping_epoch`) -- a run of 10^5 epochs costs
some 40 small matrix products.

Every epoch plans afresh from the same (optionally persisted) narrow input,
so lineage never grows with the epoch count.  The first epoch's aggregate also estimates the distinct (features,
label) combinations (HyperLogLog); when they are few, identical rows are grouped
once with a multiplicity and kept as numpy blocks, over which the later epochs run one and the same code --
the same sums, over ~10^4 rows instead of the whole input, nothing compiled per epoch.  Wide models
(many or array features) use Arrow partial vectors instead of literal sums.
"""

from __future__ import annotations

import itertools
import math
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ridgeway.model import LinearModel
from ridgeway.operators.gradient import (LOSSES, gradient_blocks, gradient_of_blocks, gradient_stats, gradient_stats_arrow,
                                         gram_stats, group_rows)
from ridgeway.operators.materialize import MODES, materialize, release

HISTORY_SCHEMA = T.StructType([
    T.StructField("epoch", T.IntegerType(), False),
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("loss", T.DoubleType(), True),
    T.StructField("param_delta", T.DoubleType(), True),
    T.StructField("stopped", T.BooleanType(), False),
])


@dataclass
class GDConfig:
    loss: str = "squared"
    lr: float = 0.001
    l2: float = 0.0
    tol: float = 1e-4
    max_epochs: int | None = 1000  # None: to the stop test (squared loss on Gram statistics)
    method: str = "auto"          # auto | gram | direct | arrow
    materialize: str = "persist"  # persist | checkpoint | none (see operators.materialize)
    compress: str = "auto"        # auto | always | never: group identical rows (direct path)
    compress_ratio: float = 0.25  # auto: compress when distinct rows <= this share of rows

    def __post_init__(self) -> None:
        if self.loss not in LOSSES:
            raise ValueError(f"loss must be one of {LOSSES}")
        if self.loss == "logistic" and self.l2:
            raise ValueError("logistic GD has no L2 term")
        if self.method not in ("auto", "gram", "direct", "arrow"):
            raise ValueError("method must be auto, gram, direct or arrow")
        if self.method == "gram" and self.loss != "squared":
            raise ValueError("the Gram path is for squared loss only")
        if self.max_epochs is None and (self.loss != "squared" or self.method in ("direct", "arrow")):
            raise ValueError("only squared loss on Gram statistics may run without an epoch limit")
        if self.materialize not in MODES:
            raise ValueError(f"materialize must be one of {MODES}")
        if self.compress not in ("auto", "always", "never"):
            raise ValueError("compress must be auto, always or never")


# The automatic Gram path adds (d+1)(d+2)/2 sums a task; above this width the per-epoch
# aggregate (d+3 sums) is the better plan, and above
# LITERAL_MAX_FEATURES the Arrow partial-vector path replaces d+3 literal sums.
GRAM_MAX_FEATURES = 64
LITERAL_MAX_FEATURES = 32

# Trainer defaults of the reference programs.
LINEAR_L2_DEFAULTS = dict(loss="squared", lr=0.001, l2=0.001, tol=1e-4)
LINEAR_DEFAULTS = dict(loss="squared", lr=1e-5, l2=0.0, tol=1e-5)
LOGISTIC_DEFAULTS = dict(loss="logistic", lr=0.15, tol=1e-4)
LOGISTIC_LR02_DEFAULTS = dict(loss="logistic", lr=0.2, tol=1e-4)


@dataclass
class GDResult:
    model: LinearModel
    history: list[tuple] = field(default_factory=list)         # of a bisected run: its last two epochs
    models: list[LinearModel] = field(default_factory=list)   # weights after each epoch, if kept

    @property
    def converged(self) -> bool:
        """Whether the stop test ended the run (else the epoch limit did)."""
        return bool(self.history) and bool(self.history[-1][4])

    def model_table(self, spark: SparkSession) -> DataFrame:
        return self.model.to_table(spark)

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)


def step(w: np.ndarray, g: np.ndarray, n: int, cfg: GDConfig) -> np.ndarray:
    if cfg.loss == "squared":
        out = w - (2.0 * cfg.lr * g / n + 2.0 * cfg.l2 * w)
        out[0] = w[0] - 2.0 * cfg.lr * g[0] / n
        return out
    return w - cfg.lr * g / n


def penalty(w: np.ndarray, cfg: GDConfig) -> float:
    if cfg.loss != "squared" or not cfg.l2:
        return 0.0
    return cfg.l2 * float(np.sum(w[1:] * w[1:]))


def stopping_epoch(stats: dict, w0: np.ndarray, cfg: GDConfig) -> tuple[int, np.ndarray, np.ndarray] | None:
    """(e, the weights it evaluates, those of the epoch before): the first epoch e with loss(e-1) - loss(e) <= tol, for squared loss without
    L2.  None where the steps of the loss need not shrink (a step beyond 2 / the largest curvature, or an L2 term, which
    the reported loss does not weigh as the step does) -- then the epochs are run one by one.

    Weights after k epochs are T^k (w, 1) for the affine map T of one epoch.  With all factors of T
    in [-1, 1] the k-th fall of the loss is a sum of c_i r_i^(2k) with c_i >= 0, so it shrinks."""
    n, d = stats["n"], len(w0)
    if not n or cfg.l2 or cfg.tol < 0 or not np.isfinite(stats["G"]).all():
        return None
    G, h = stats["G"] / n, stats["h"] / n
    top = float(np.linalg.eigvalsh(G)[-1])
    if not 0 <= 2.0 * cfg.lr * top <= 2.0:
        return None
    T = np.eye(d + 1)
    T[:d, :d] -= 2.0 * cfg.lr * G
    T[:d, d] = 2.0 * cfg.lr * h
    powers = [T]

    def at(k: int) -> np.ndarray:
        v, j = np.append(w0, 1.0), 0
        while k:
            if j == len(powers):
                powers.append(powers[-1] @ powers[-1])
            if k & 1:
                v = powers[j] @ v
            k, j = k >> 1, j + 1
        return v[:d]

    def fall(k: int) -> float:
        """loss(w_k) - loss(w_k+1), from the step itself: no difference of two near numbers."""
        w = at(k)
        g = G @ w - h
        s = -2.0 * cfg.lr * g
        return -float(2.0 * (g @ s) + s @ (G @ s))

    high = 1
    while fall(high - 1) > cfg.tol:
        if high > 1 << 60:
            return None
        high *= 2
    low = high // 2           # fall(low - 1) > tol (or low is 0)
    while high - low > 1:
        mid = (low + high) // 2
        if fall(mid - 1) > cfg.tol:
            low = mid
        else:
            high = mid
    # fall(high - 1) is the first fall within tol: epoch high + 1 evaluates w_high and stops
    return high + 1, at(high), at(high - 1)


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a narrow input over the cluster's cores when it arrives in
    fewer partitions than that (small files).  Large inputs already have
    thousands of splits and are left alone -- no shuffle of big data."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def gram_loss(stats: dict, w: np.ndarray) -> float:
    return float(w @ (stats["G"] @ w) - 2.0 * (w @ stats["h"]) + stats["q"]) / stats["n"]


def _bisected(stats: dict, cfg: GDConfig, epoch: int, w: np.ndarray, before: np.ndarray) -> GDResult:
    """The result of a run whose stopping epoch is known: the history holds its last two epochs."""
    moved = float(np.linalg.norm(w - before))
    return GDResult(LinearModel.from_vector(w), [(epoch - 1, stats["n"], gram_loss(stats, before), moved, False),
                                                 (epoch, stats["n"], gram_loss(stats, w), 0.0, True)])


def train_gd(rows: DataFrame, features: Sequence[str] | str, label: str, cfg: GDConfig,
             init: LinearModel | Sequence[float] | None = None,
             on_epoch: Callable[[tuple], None] | None = None,
             n_features: int | None = None, log=None, keep_models: bool = False) -> GDResult:
    """Train until the stop test or ``cfg.max_epochs`` (with a warning: see
    ``GDResult.converged``); ``on_epoch`` gets each history row, and ``keep_models`` keeps
    the model of every epoch.

    ``features`` is a list of double columns, or one ``array<double>`` column
    (then ``n_features`` or ``init`` gives d, and the Arrow path is used).
    ``log`` (a :class:`~ridgeway.sources.training_log.TrainingLog`) records every
    epoch and, when it already holds epochs, the run continues after them.
    """
    done = log.resume() if log is not None else None
    if done is not None:
        hist, last_model = done
        if hist[-1][4] or (cfg.max_epochs is not None and len(hist) >= cfg.max_epochs):   # finished before the restart
            return GDResult(last_model, list(hist), [])
        init = last_model
    wide_col = isinstance(features, str)
    if wide_col:
        if init is None and n_features is None:
            raise ValueError("an array feature column needs n_features or init")
        d = n_features if n_features is not None else (
            init.n_features if isinstance(init, LinearModel) else len(init) - 1)
    else:
        d = len(features)
    if init is None:
        w = np.zeros(d + 1)
    elif isinstance(init, LinearModel):
        w = init.vector().copy()
    else:
        w = np.asarray(init, dtype=np.float64).copy()
    if len(w) != d + 1:
        raise ValueError(f"initial weights have {len(w)} cells, expected {d + 1}")

    method = cfg.method
    if method == "auto":
        if cfg.max_epochs is None:
            method = "gram"
        elif wide_col or d > GRAM_MAX_FEATURES or (cfg.loss == "logistic" and d > LITERAL_MAX_FEATURES):
            method = "arrow"
        else:
            method = "gram" if cfg.loss == "squared" else "direct"
    if wide_col and method not in ("arrow", "gram"):
        raise ValueError("an array feature column is trained with the arrow or the Gram path")
    narrow = rows.select(features, label) if wide_col else rows.select(*features, label)
    cached = None
    if method == "gram":
        stats = gram_stats(narrow, features, label, d)
        if cfg.max_epochs is None and done is None and log is None and on_epoch is None and not keep_models:
            found = stopping_epoch(stats, w, cfg)
            if found is not None:
                return _bisected(stats, cfg, *found)

        def evaluate(wv: np.ndarray) -> tuple[int, float, np.ndarray]:
            G, h, q, n = stats["G"], stats["h"], stats["q"], stats["n"]
            Gw = G @ wv
            return n, float(wv @ Gw - 2.0 * (wv @ h) + q), Gw - h
    else:
        src, blocks = narrow, None

        def keep() -> None:
            nonlocal src, cached
            if cfg.materialize != "none":
                src, cached = materialize(spread(src), cfg.materialize)

        def group(k: int | None) -> None:
            nonlocal blocks, cached
            blocks, cached = materialize(gradient_blocks(group_rows(src, features, label, "_mult", k), features, label, "_mult"),
                                         cfg.materialize)

        estimate = method == "direct" and cfg.compress == "auto"
        if method == "direct" and cfg.compress == "always":
            group(None)
        elif not estimate:
            keep()

        if method == "arrow":
            def evaluate(wv: np.ndarray) -> tuple[int, float, np.ndarray]:
                return gradient_stats_arrow(src, features, label, wv, cfg.loss)
        else:
            def evaluate(wv: np.ndarray) -> tuple[int, float, np.ndarray]:
                nonlocal estimate
                if blocks is not None:
                    return gradient_of_blocks(blocks, wv, cfg.loss)
                r = gradient_stats(src, features, label, list(wv), cfg.loss, distinct=estimate).collect()[0]
                if r["n_valid"] != r["n_groups"]:
                    raise ValueError("NULL or NaN in features or label")
                if estimate:             # decided once, by the first epoch's own pass
                    estimate = False
                    if r["n_rows"] and r["n_distinct"] <= cfg.compress_ratio * r["n_rows"]:
                        group(int(r["n_distinct"]))
                    else:
                        keep()
                g = np.array([0.0 if r[f"g{i}"] is None else r[f"g{i}"] for i in range(d + 1)])
                loss_sum = float("nan") if r["loss_sum"] is None else float(r["loss_sum"])
                return int(r["n_rows"] or 0), loss_sum, g

    result = GDResult(LinearModel.from_vector(w))
    prev, first = math.inf, 1
    if done is not None:
        result.history = list(hist)
        prev, first = hist[-1][2], len(hist) + 1   # the last logged epoch stepped from this loss

    def logged(row: tuple) -> None:
        if log is not None:
            log.record(row, LinearModel.from_vector(w))
        if on_epoch:
            on_epoch(row)

    try:
        for epoch in itertools.count(first):
            if cfg.max_epochs is not None and epoch > cfg.max_epochs:
                break
            n, loss_sum, g = evaluate(w)
            loss = (loss_sum / n if n else float("nan")) + penalty(w, cfg)
            if prev - loss > cfg.tol:
                w_new = step(w, g, n, cfg)
                delta = float(np.sqrt(np.sum((w_new - w) ** 2)))
                result.history.append((epoch, n, float(loss), delta, False))
                w, prev = w_new, loss
                if keep_models:
                    result.models.append(LinearModel.from_vector(w))
                logged(result.history[-1])
            else:
                result.history.append((epoch, n, float(loss), 0.0, True))
                if keep_models:
                    result.models.append(LinearModel.from_vector(w))
                logged(result.history[-1])
                break
    finally:
        release(cached)
    result.model = LinearModel.from_vector(w)
    if not result.converged and cfg.tol >= 0:
        warnings.warn(f"gradient descent ended at max_epochs={cfg.max_epochs} before its stop test", stacklevel=2)
    return result
