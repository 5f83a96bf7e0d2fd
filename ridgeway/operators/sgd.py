"""Parameter-averaged SGD over explicit shards (Zinkevich et al. 2010).

Plan of one epoch::

    prepared (shard = scrambled id mod S; placed by repartitionById on pmod(shard, P),
              sorted by (shard, id) inside its partition; shuffled ONCE and persisted)
      -> blocks of whole shards (numpy, up to LOCKSTEP_BYTES), persisted for all epochs
      -> one fold a task        each block is put in the epoch's order and its shards are folded
                                side by side; the task emits the SUM of its shard models
      -> sum of the task arrays (in a tree when they are many)

The loop over the blocks is the one place of the library that runs on an RDD: the fold is imperative
code over whole partitions, and a pass over persisted blocks needs no plan of its own.
Shards larger than a block stay rows: Spark sorts them into the epoch's order
(``sortWithinPartitions``, which spills) and they are folded one row at a time as they stream by
(``mapInArrow``; the task arrays are added by operators.array_sum).

With ``reshard`` the rows are dealt to the shards anew each epoch, as the reference does: the shard rule takes the
epoch in, and each pass plans one exchange over the persisted rows.  Without it (the default)
rows keep their shard and all epochs share one exchange; both are fixed by the row id alone.

The driver then averages: (sum over non-empty shards + empty shards x
incoming model) / S -- an unweighted mean over exactly S shards, so the
answer depends on the shard count and never on the cluster's partitioning.
The stop test (||new - old|| < tol) is applied after adopting the new model.

S is either given (``shards``, exact at every size) or follows from the rows
(``rows_per_shard``: S = ceil(rows / rows_per_shard), at every size); there is no
third rule.  Rows cannot pile up in a shard: shards come from the unique row id, scrambled by an integer
rule before the modulo, so even strided ids spread evenly.
"""

from __future__ import annotations

import math
import pickle
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.model import MAX_MODEL_CELLS, LinearModel
from ridgeway.operators import array_sum
from ridgeway.operators.arrow_rows import feature_matrix, labels
from ridgeway.operators.folds import FOLDS, KINDS, ShardState, fold_shards
from ridgeway.operators.materialize import MODES, materialize, release
from ridgeway.operators.gd import HISTORY_SCHEMA

# Integer rule for the per-epoch row order inside a shard, chosen so
# that any engine can recompute it exactly: pmod(id, M) * (A^epoch mod M) mod M with
# M = 2^31 - 1 and a primitive root A.  Another multiplier each epoch makes another order,
# not a rotation of the last one; products stay inside int64 for any long id.
ORDER_ROOT = 48271
ORDER_MOD = 2147483647

# Integer rule assigning a row id to a shard, scrambled before the
# modulo so that structured ids (strides, multiples of S) still spread evenly;
# pmod(id, SHARD_MOD) first keeps every product inside int64 for any long id.
SHARD_MULT = 1327217885
SHARD_ADD = 3
SHARD_MOD = 2147483647
# With reshard, epoch e multiplies by SHARD_MULT * SHARD_ROOT^e mod M instead (a primitive
# root other than the one of the order, so order and shard do not go together).
SHARD_ROOT = 69621

# Trainer defaults of the reference programs.
HINGE_DEFAULTS = dict(kind="hinge", alpha=0.01, l2=1.0, max_iter=20, tol=1e-3)
HINGE_ETA_DEFAULTS = dict(kind="hinge", alpha=0.1, l2=1.0, max_iter=300, tol=1e-3)
MULTICLASS_HINGE_DEFAULTS = dict(kind="multiclass_hinge", alpha=0.01, l2=1e-4, max_iter=250, tol=1e-4)
SOFTMAX_DEFAULTS = dict(kind="softmax", alpha=0.05, l2=0.0, max_iter=450, tol=1e-4)

# Rows that one task folds at most by default, and model cells (rows x K x (d+1)) below which another
# task costs more than it saves (several small shards share a task); plans only.
ROWS_PER_TASK = 1_000_000
MIN_TASK_CELLS = 2_000_000

# Rows of a block: shards that are folded side by side.
LOCKSTEP_BYTES = 32 << 20


@dataclass
class SGDConfig:
    kind: str = "hinge"
    alpha: float = 0.01
    l2: float = 1.0
    fit_intercept: bool = True
    shards: int | None = None    # exactly this many shards (4 if neither is given) ...
    max_iter: int = 20
    tol: float = 1e-3
    order: str = "hash"          # hash: see ORDER_ROOT, then id; id: by id
    materialize: str = "persist"  # persist | checkpoint | none (see operators.materialize)
    rows_per_shard: int | None = None  # ... or ceil(rows / rows_per_shard) shards
    max_partitions: int | None = None  # tasks for the shards; None: auto (see resolve_partitions)
    reshard: bool = False        # deal the rows to the shards anew each epoch (one exchange a pass)

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}")
        if self.shards is not None and self.rows_per_shard is not None:
            raise ValueError("give shards or rows_per_shard, not both")
        if self.shards is None and self.rows_per_shard is None:
            self.shards = 4
        if (self.shards or self.rows_per_shard) < 1:
            raise ValueError("shards and rows_per_shard must be >= 1")
        if self.order not in ("hash", "id"):
            raise ValueError("order must be hash or id")
        if self.materialize not in MODES:
            raise ValueError(f"materialize must be one of {MODES}")


@dataclass
class SGDResult:
    model: LinearModel
    history: list[tuple] = field(default_factory=list)
    models: list[LinearModel] = field(default_factory=list)   # after each epoch, if kept
    shards: int = 0

    @property
    def converged(self) -> bool:
        """Whether the stop test ended the run (else the pass limit did)."""
        return bool(self.history) and bool(self.history[-1][4])

    def model_table(self, spark: SparkSession) -> DataFrame:
        return self.model.to_table(spark)

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)


def shard_key(id_col: Column, shards: int, epoch: int = 0) -> Column:
    """Shard of a row: pmod(pmod(pmod(id, M) * m + 3, M), S), M = 2^31 - 1, with m = 1327217885 * 69621^epoch mod M
    (epoch 0: shards that stay); products stay below 2.9e18, inside int64."""
    mult = SHARD_MULT * pow(SHARD_ROOT, int(epoch), SHARD_MOD) % SHARD_MOD
    scrambled = F.pmod(F.pmod(id_col, F.lit(SHARD_MOD)) * F.lit(mult).cast("long") + F.lit(SHARD_ADD),
                       F.lit(SHARD_MOD))
    return F.pmod(scrambled, F.lit(shards)).cast("int")


def order_factor(epoch: int) -> int:
    return pow(ORDER_ROOT, int(epoch), ORDER_MOD)


def order_key(id_col: Column, epoch: int) -> Column:
    factor = F.lit(order_factor(epoch)).cast("long")
    return F.pmod(F.pmod(id_col, F.lit(ORDER_MOD)) * factor, F.lit(ORDER_MOD))


def narrow_rows(rows: DataFrame, id_col: str, features: Sequence[str] | str, label: str) -> DataFrame:
    """``id long, features array<double>, label double``."""
    feats = (F.col(features) if isinstance(features, str)
             else F.array(*[F.col(c) for c in features])).cast("array<double>")
    return rows.select(F.col(id_col).cast("long").alias("id"), feats.alias("features"),
                       F.col(label).cast("double").alias("label"))


def place(narrow: DataFrame, shards: int, max_partitions: int | None = None, epoch: int = 0) -> DataFrame:
    """``shard, id, features, label`` placed by shard: one shard per partition, or ``pmod(shard, P)`` with
    ``P = min(shards, max_partitions)``."""
    P = shards if max_partitions is None else max(1, min(shards, max_partitions))
    out = narrow.select(shard_key(F.col("id"), shards, epoch).alias("shard"), "id", "features", "label")
    return out.repartitionById(P, F.pmod(F.col("shard"), F.lit(P)))


def prepare_shards(rows: DataFrame, id_col: str, features: Sequence[str] | str, label: str,
                   shards: int, max_partitions: int | None = None) -> DataFrame:
    return place(narrow_rows(rows, id_col, features, label), shards, max_partitions)


class _TaskFold:
    """The shards of one task whose rows arrive shard by shard in the epoch's order: whole shards are buffered and folded
    together, a shard beyond the buffer is folded as it streams by."""

    def __init__(self, cfg: SGDConfig, start: LinearModel) -> None:
        self.kind, self.step = cfg.kind, (cfg.alpha, cfg.l2, cfg.fit_intercept)
        self.coef, self.intercept = start.coef, start.intercept
        self.W, self.b = np.zeros_like(start.coef), np.zeros_like(start.intercept)
        self.loss, self.rows, self.shards = 0.0, 0, 0
        self.cur, self.live = None, None       # live: state of a shard that is streamed
        self.pieces, self.lengths, self.bytes = [], [], 0

    def add(self, shard: int, X: np.ndarray, y: np.ndarray) -> None:
        if shard != self.cur:
            if self.cur is not None and shard < self.cur:
                raise ValueError("rows of a shard must be contiguous in their partition")
            self._end_live()
            if self.bytes >= LOCKSTEP_BYTES:
                self._flush()
            self.cur = shard
            self.lengths.append(0)
            self.shards += 1
        self.rows += len(y)
        if self.live is not None:
            FOLDS[self.kind](self.live, X, y, *self.step)
            return
        self.pieces.append((X, y))
        self.lengths[-1] += len(y)
        self.bytes += X.nbytes + y.nbytes
        if self.lengths[-1] * (X.shape[1] + 1) * 8 > LOCKSTEP_BYTES:
            n = self.lengths.pop()
            X, y = (np.concatenate(part) for part in zip(*self.pieces))
            self._fold(X[:len(y) - n], y[:len(y) - n])
            self.live = ShardState(self.coef, self.intercept)
            FOLDS[self.kind](self.live, X[len(y) - n:], y[len(y) - n:], *self.step)

    def _end_live(self) -> None:
        if self.live is not None:
            self.W += self.live.coef
            self.b += self.live.intercept
            self.loss += self.live.loss_sum
            self.live = None

    def _fold(self, X: np.ndarray, y: np.ndarray) -> None:
        if self.lengths:
            W, b, loss = fold_shards(self.kind, self.coef, self.intercept, X, y, self.lengths, *self.step)
            self.W += W
            self.b += b
            self.loss += loss
        self.pieces, self.lengths, self.bytes = [], [], 0

    def _flush(self) -> None:
        if self.pieces:
            self._fold(*(np.concatenate(part) for part in zip(*self.pieces)))

    def result(self) -> np.ndarray:
        self._end_live()
        self._flush()
        model = np.hstack([self.b.reshape(-1, 1), self.W]).reshape(-1)
        return np.concatenate([model, [float(self.rows), self.loss, float(self.shards)]])


def _row_arrays(rb: pa.RecordBatch, kind: str, n_classes: int, d: int):
    """(shard, ids, X, y) of a batch, checked."""
    return (rb.column("shard").to_numpy(zero_copy_only=False), rb.column("id").to_numpy(zero_copy_only=False),
            feature_matrix(rb.column("features"), d), labels(rb.column("label"), kind, n_classes))


def _fold_fn(cfg: SGDConfig, start: LinearModel, n_buckets: int):
    """Per task: the SUM of its shard models plus (rows, loss, shards) as one array."""
    K, d = start.n_classes, start.n_features

    def run(batches):
        fold = _TaskFold(cfg, start)
        for rb in batches:
            if not rb.num_rows:
                continue
            shard, _, X, y = _row_arrays(rb, cfg.kind, K, d)
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), rb.num_rows]):
                fold.add(int(shard[a]), X[a:b], y[a:b])
        if fold.shards:
            yield array_sum.rows(fold.result(), array_sum.task_bucket(n_buckets))

    return run


def shard_models(prepared: DataFrame, model: LinearModel, epoch: int, cfg: SGDConfig) -> DataFrame:
    """One epoch's fold output over rows: per task, the sum of its shard models as array chunks."""
    ordered = (prepared.withColumn("ord", order_key(F.col("id"), epoch))
                       .sortWithinPartitions("shard", "ord", "id") if cfg.order == "hash"
               else prepared.sortWithinPartitions("shard", "id"))
    fn = _fold_fn(cfg, model, array_sum.buckets(cfg.max_partitions or cfg.shards))
    return ordered.select("shard", "id", "features", "label").mapInArrow(fn, array_sum.SCHEMA)


def _pack_fn(kind: str, n_classes: int, d: int):
    """Rows sorted by (shard, id) -> blocks of whole shards as pickled (lengths, ids, X, y)."""
    def run(batches):
        lengths, pieces, size, cur = [], [], 0, None

        def block() -> pa.RecordBatch:
            X, y, ids = (np.concatenate(part) for part in zip(*pieces))
            made = pickle.dumps((np.array(lengths), ids, X, y), protocol=5)
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["block"])

        for rb in batches:
            if not rb.num_rows:
                continue
            shard, ids, X, y = _row_arrays(rb, kind, n_classes, d)
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), rb.num_rows]):
                if shard[a] != cur:
                    if size >= LOCKSTEP_BYTES:
                        yield block()
                        lengths, pieces, size = [], [], 0
                    cur = shard[a]
                    lengths.append(0)
                pieces.append((X[a:b], y[a:b], ids[a:b]))
                lengths[-1] += b - a
                size += (b - a) * (d + 2) * 8
        if lengths:
            yield block()

    return run


def shard_blocks(prepared: DataFrame, kind: str, n_classes: int, d: int):
    """The placed rows as an RDD of blocks; labels and features are checked here, once."""
    made = prepared.sortWithinPartitions("shard", "id").select("shard", "id", "features", "label")
    return made.mapInArrow(_pack_fn(kind, n_classes, d), "block binary").rdd.map(lambda r: pickle.loads(r[0]))


def _fold_blocks_fn(cfg: SGDConfig, start: LinearModel, factor: int | None):
    kind, step, coef, intercept = cfg.kind, (cfg.alpha, cfg.l2, cfg.fit_intercept), start.coef, start.intercept

    def run(blocks):
        W, b, rows, loss, shards = np.zeros_like(coef), np.zeros_like(intercept), 0, 0.0, 0
        for lengths, ids, X, y in blocks:
            order = None
            if factor is not None:
                key = ids % ORDER_MOD * factor % ORDER_MOD
                order = np.lexsort((key, np.repeat(np.arange(len(lengths)), lengths)))   # stable: ties stay by id
            w, c, l = fold_shards(kind, coef, intercept, X, y, lengths, *step, order)
            W, b, loss = W + w, b + c, loss + l
            rows, shards = rows + len(y), shards + len(lengths)
        if shards:
            yield np.concatenate([np.hstack([b.reshape(-1, 1), W]).reshape(-1), [float(rows), loss, float(shards)]])

    return run


def run_epoch(prepared, model: LinearModel, epoch: int,
              cfg: SGDConfig) -> tuple[LinearModel, int, float, int]:
    """One averaged pass over placed rows (a DataFrame) or blocks (an RDD)
    -> (new model, rows seen, online loss sum, non-empty shards)."""
    K, d = model.n_classes, model.n_features
    cells = K * (d + 1)
    tasks = cfg.max_partitions or cfg.shards
    if isinstance(prepared, DataFrame):
        total = array_sum.total(shard_models(prepared, model, epoch, cfg), cells + 3, tasks)
    else:
        sums = prepared.mapPartitions(_fold_blocks_fn(cfg, model, order_factor(epoch) if cfg.order == "hash" else None))
        if tasks * cells <= array_sum.DIRECT_VALUES:
            total = sum(sums.collect(), np.zeros(cells + 3))        # checked: at most DIRECT_VALUES numbers
        else:
            total = sums.treeAggregate(np.zeros(cells + 3), lambda a, b: a + b, lambda a, b: a + b, depth=2)
    n_rows, loss_sum, nonempty = int(round(total[cells])), float(total[cells + 1]), int(round(total[cells + 2]))
    S = cfg.shards
    avg = (total[:cells] + (S - nonempty) * model.flat()) / S
    new = LinearModel.from_flat(avg, K, d)
    if not cfg.fit_intercept:
        new.intercept[:] = 0.0
    return new, n_rows, loss_sum, nonempty


def resolve_shards(n_rows: int, cfg: SGDConfig) -> int:
    """``shards`` as given, or ``ceil(n_rows / rows_per_shard)`` (1 for no rows)."""
    if cfg.rows_per_shard is None:
        return cfg.shards
    return max(1, math.ceil(n_rows / cfg.rows_per_shard))


def resolve_partitions(n_rows: int, shards: int, cfg: SGDConfig, slots: int, cells: int | None = None) -> int:
    """Tasks that fold the shards: ``min(shards, max_partitions)`` when given, else
    ``max(slots, ceil(rows / ROWS_PER_TASK))`` and never more than shards -- fewer than slots where
    ``cells`` (of a row's update, K x (d+1)) say that a task would hold less than MIN_TASK_CELLS, but two."""
    if cfg.max_partitions is not None:
        return max(1, min(shards, cfg.max_partitions))
    if cells is not None:
        slots = max(2, min(slots, math.ceil(n_rows * cells / MIN_TASK_CELLS)))
    return max(1, min(shards, max(slots, math.ceil(n_rows / ROWS_PER_TASK))))


def fits_in_block(n_rows: int, shards: int, d: int) -> bool:
    """Whether a shard of twice the mean size fits a block."""
    return 2 * math.ceil(n_rows / shards) * (d + 2) * 8 <= LOCKSTEP_BYTES


def _scan_stats(rows: DataFrame, features: Sequence[str] | str, label: str,
                kind: str, need_shape: bool, n_classes: int | None = None) -> tuple[int, int | None, int | None]:
    """(rows, K, d) in one aggregate, which also checks every label; K = distinct labels
    (1 for binary hinge)."""
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.count(y).alias("n_y"), F.min(y).alias("ymin"), F.max(y).alias("ymax"),
            F.count(F.when(F.abs(y) != 1.0, F.lit(1)) if kind == "hinge" else F.when(y != F.floor(y), F.lit(1))).alias("n_bad")]
    if need_shape:
        if kind != "hinge":  # binary models have K = 1; no distinct count needed
            aggs += [F.countDistinct(label).alias("k")]
        if isinstance(features, str):
            aggs += [F.min(F.size(features)).alias("dmin"), F.max(F.size(features)).alias("dmax")]
    r = rows.agg(*aggs).collect()[0]
    if r["n_y"] != r["n"]:
        raise ValueError("NULL or NaN in features or label")
    if r["n_bad"]:
        raise ValueError("hinge labels must be -1 or 1" if kind == "hinge" else "class labels must be whole numbers")
    if kind != "hinge" and r["n"] and r["ymin"] < 0:
        raise ValueError("class labels must be 0..K-1")
    if kind != "hinge" and n_classes is not None and r["n"] and r["ymax"] >= n_classes:
        raise ValueError("class labels must be 0..K-1")
    if not need_shape:
        return int(r["n"]), None, None
    if isinstance(features, str):
        if r["dmin"] != r["dmax"]:
            raise ValueError("feature arrays have different lengths")
        d = int(r["dmax"]) if r["dmax"] is not None else 0
    else:
        d = len(features)
    if kind == "hinge":
        return int(r["n"]), 1, d
    k = int(r["k"])
    if n_classes is None and r["ymax"] is not None and int(r["ymax"]) >= k:
        raise ValueError("class labels must be 0..K-1")
    return int(r["n"]), k, d


def infer_shape(rows: DataFrame, features: Sequence[str] | str, label: str,
                kind: str) -> tuple[int, int]:
    """(K, d) from the data: K = number of distinct labels (1 for binary hinge)."""
    _, k, d = _scan_stats(rows, features, label, kind, True)
    return k, d


def train_sgd(rows: DataFrame, id_col: str, features: Sequence[str] | str, label: str,
              cfg: SGDConfig, init: LinearModel | None = None,
              n_classes: int | None = None,
              on_epoch: Callable[[tuple], None] | None = None, log=None, keep_models: bool = False) -> SGDResult:
    """Averaged passes until ||new - old|| < tol or ``max_iter`` (with a warning: see
    ``SGDResult.converged``); ``on_epoch`` gets each history row, ``keep_models`` keeps the
    model of every epoch.

    ``log`` (a :class:`~ridgeway.sources.training_log.TrainingLog`) records every
    epoch and, when it already holds epochs, the run continues after them.
    """
    done = log.resume() if log is not None else None
    if done is not None:
        hist, last_model = done
        if hist[-1][4] or len(hist) >= cfg.max_iter:   # finished before the restart
            return SGDResult(last_model, list(hist), [], 0)
        init = last_model
    n, K, d = _scan_stats(rows, features, label, cfg.kind, init is None, n_classes if init is None else init.n_classes)
    if init is None:
        init = LinearModel.zeros(n_classes or K, d)
    if init.n_classes * (init.n_features + 1) > MAX_MODEL_CELLS:
        raise ValueError("model too large for the averaged-SGD driver loop")
    S = resolve_shards(n, cfg)
    P = resolve_partitions(n, S, cfg, rows.sparkSession.sparkContext.defaultParallelism, init.n_classes * (init.n_features + 1))
    run = replace(cfg, shards=S, rows_per_shard=None, max_partitions=P)
    as_blocks = fits_in_block(n, S, init.n_features)
    narrow = narrow_rows(rows, id_col, features, label)

    def placed(epoch: int = 0):
        out = place(narrow, S, P, epoch)
        return shard_blocks(out, cfg.kind, init.n_classes, init.n_features) if as_blocks else out

    if cfg.reshard:
        narrow, held = materialize(narrow, run.materialize)
    else:
        prepared, held = materialize(placed(), run.materialize)
    model = init.copy()
    if not cfg.fit_intercept:
        model.intercept[:] = 0.0
    result = SGDResult(model, shards=run.shards)
    first = 1
    if done is not None:
        result.history, first = list(hist), len(hist) + 1
    try:
        for epoch in range(first, run.max_iter + 1):
            new, n_rows, loss_sum, _ = run_epoch(placed(epoch) if cfg.reshard else prepared, model, epoch, run)
            delta = new.delta_norm(model)
            stopped = bool(delta < run.tol)
            mean_loss = loss_sum / n_rows if n_rows else None
            result.history.append((epoch, n_rows, mean_loss, delta, stopped))
            if keep_models:
                result.models.append(new)
            if log is not None:
                log.record(result.history[-1], new)
            if on_epoch:
                on_epoch(result.history[-1])
            model = new
            if stopped:
                break
    finally:
        release(held)
    result.model = model
    if not result.converged and run.tol > 0 and run.max_iter > 1:
        warnings.warn(f"averaged SGD ended at max_iter={run.max_iter} before its stop test", stacklevel=2)
    return result


def sgd_pass(rows: DataFrame, id_col: str, features: Sequence[str] | str, label: str,
             cfg: SGDConfig, model: LinearModel, epoch: int = 1,
             n_rows: int | None = None) -> tuple[LinearModel, int, float]:
    """One averaged pass from ``model`` (the online / partial-fit update);
    ``n_rows`` saves a count when the caller already knows it."""
    if n_rows is not None:
        n = n_rows
    else:
        n = rows.count() if cfg.rows_per_shard is not None else 0  # exact shards need no count
    S = resolve_shards(n, cfg)
    P = resolve_partitions(n, S, cfg, rows.sparkSession.sparkContext.defaultParallelism)
    run = replace(cfg, shards=S, rows_per_shard=None, max_partitions=P)
    prepared = place(narrow_rows(rows, id_col, features, label), S, P, epoch if cfg.reshard else 0)
    new, n_rows, loss_sum, _ = run_epoch(prepared, model, epoch, run)
    return new, n_rows, loss_sum


def models_table(spark: SparkSession, models: Sequence[LinearModel], start: int = 0) -> DataFrame:
    """Stack models as ``epoch, class_idx, feature_idx, weight`` (epoch = start, start+1, ...),
    built as one small local table (size-checked: epochs x cells)."""
    cells = sum(m.n_classes * (m.n_features + 1) for m in models)
    if cells > MAX_MODEL_CELLS:
        raise ValueError("model history too large to build on the driver")
    rows = []
    for e, m in enumerate(models, start):
        flat = m.flat().reshape(m.n_classes, m.n_features + 1)
        rows += [(int(e), int(c), int(j), float(flat[c, j]))
                 for c in range(m.n_classes) for j in range(m.n_features + 1)]
    return spark.createDataFrame(rows, "epoch int, class_idx int, feature_idx int, weight double")


def model_delta_norm(models: DataFrame) -> DataFrame:
    """Per epoch e >= 1: sqrt(sum over cells of (w_e - w_{e-1})^2), as a Spark
    aggregate over a model-history table (each side is one model per epoch)."""
    prev = models.select((F.col("epoch") + F.lit(1)).alias("epoch"), "class_idx", "feature_idx",
                         F.col("weight").alias("w_prev"))
    d = models.join(prev, ["epoch", "class_idx", "feature_idx"])
    return (d.groupBy("epoch")
             .agg(F.sqrt(F.sum((F.col("weight") - F.col("w_prev")) * (F.col("weight") - F.col("w_prev"))))
                  .alias("param_delta"))
             .select(F.col("epoch").cast("int"), "param_delta"))
