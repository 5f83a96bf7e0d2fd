"""Scoring and gradient descent for models larger than the driver may hold.

The model is never collected: it stays a long table ``class_idx, feature_idx, weight``
(``feature_idx`` 0 is the intercept) of which one task sees blocks of ``block_size`` cells.
Rows are unpivoted to ``(row, y, block, pos, x)``: the cells of one row in one feature block,
as positions and values, so sparse rows stay sparse.  An epoch is three joins on partitionings
that the kept inputs already have:

1. partial products: cells, dealt by ``(block, part)``, meet the model's blocks; ``part`` (a hash
   of the row) splits every block over ``parts`` tasks, because block 0 holds every row;
2. ``z`` of a row is the sum of its partial products (one number a row and block moves);
3. cells, dealt by ``row``, meet the rows' gradient factors, and the terms are summed by feature,
   partial sums first, so at most one number a feature leaves a task.

The step is :func:`~ridgeway.operators.gradient.gradient_step_join`'s rule on a left join (a feature
without any cell still decays).  Each epoch's model is a Parquet table in the shared folder, read back for the
next one: lineage does not grow and a lost executor recomputes from files.  The driver holds
four numbers an epoch.

Row ids must be unique and not NULL; labels and values must be numbers.  Each is checked.
"""

from __future__ import annotations

import itertools
import math
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.functions.linear import logistic_nll, sigmoid
from ridgeway.operators.gd import HISTORY_SCHEMA, GDConfig
from ridgeway.operators.gradient import step_expression
from ridgeway.operators.materialize import materialize, release
from ridgeway.session import scratch_path

BLOCK_SIZE = 4096


def _part(row, parts: int):
    return F.pmod(F.xxhash64(row), F.lit(parts)).cast("int")


def cells_of_arrays(rows: DataFrame, features: str, label: str, id_col: str, n_features: int,
                    block_size: int = BLOCK_SIZE) -> DataFrame:
    """``row, y, block, pos, x`` of rows with a dense array column; no shuffle.  A row of
    another length raises."""
    cells = n_features + 1
    xs = F.col(features).cast("array<double>")
    sized = F.when(F.size(xs) == F.lit(n_features), F.concat(F.array(F.lit(1.0)), xs)).otherwise(
        F.raise_error(F.lit(f"a row has not {n_features} features")).cast("array<double>"))
    src = rows.select(F.col(id_col).alias("row"), F.col(label).cast("double").alias("y"), sized.alias("v"))
    blocks = F.sequence(F.lit(0), F.lit((cells - 1) // block_size))
    return (src.select("row", "y", "v", F.explode(blocks).alias("block"))
               .withColumn("x", F.slice("v", F.col("block") * block_size + 1, block_size))
               .select("row", "y", "block", F.transform("x", lambda _, i: i).alias("pos"), "x"))


def cells_of_pairs(rows: DataFrame, pairs: DataFrame, label: str, id_col: str, n_features: int,
                   block_size: int = BLOCK_SIZE) -> DataFrame:
    """The same from sparse rows: ``rows`` (id, label) and ``pairs`` (id, ``feature_idx`` from 1 to ``n_features``,
    ``value``).  Cells that stand twice count twice, as one sum; a pair without a row is ignored."""
    n = F.lit(n_features)
    at = F.when(F.col("feature_idx").between(F.lit(1), n), F.col("feature_idx")).otherwise(
        F.raise_error(F.lit(f"feature_idx must be from 1 to {n_features}")).cast("long"))
    long = pairs.select(F.col(id_col).alias("row"), at.cast("long").alias("j"), F.col("value").cast("double").alias("v"))
    every = long.unionByName(rows.select(F.col(id_col).alias("row"), F.lit(0).cast("long").alias("j"), F.lit(1.0).alias("v")))
    size = F.lit(block_size)
    grouped = (every.groupBy("row", F.floor(F.col("j") / size).cast("int").alias("block"))
               .agg(F.collect_list(F.struct(F.pmod("j", size).cast("int").alias("pos"), "v")).alias("c"))
               .select("row", "block", F.col("c.pos").alias("pos"), F.col("c.v").alias("x")))
    return grouped.join(rows.select(F.col(id_col).alias("row"), F.col(label).cast("double").alias("y")), "row") \
                  .select("row", "y", "block", "pos", "x")


def zero_model(spark: SparkSession, n_features: int) -> DataFrame:
    return spark.range(n_features + 1).select(F.lit(0).alias("class_idx"), F.col("id").cast("int").alias("feature_idx"),
                                              F.lit(0.0).alias("weight"))


def _blocks(model: DataFrame, block_size: int) -> DataFrame:
    """``block, w``: the weights of a block in order (at most ``block_size``)."""
    cell = F.struct(F.pmod("feature_idx", F.lit(block_size)).alias("pos"), "weight")
    return (model.groupBy(F.floor(F.col("feature_idx") / F.lit(block_size)).cast("int").alias("block"))
            .agg(F.array_sort(F.collect_list(cell)).alias("c")).select("block", F.col("c.weight").alias("w")))


def predictor(cells: DataFrame, model: DataFrame, block_size: int = BLOCK_SIZE, parts: int = 1) -> DataFrame:
    """``row, y, z`` with z = w0 + w.x, the model joined by block.  ``cells`` may carry ``part`` already.
    A cell whose weight the model does not hold raises."""
    if "part" not in cells.columns:
        cells = cells.withColumn("part", _part("row", parts))
    blocks = _blocks(model, block_size).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    terms = F.zip_with("pos", "x", lambda p, x: F.when(p < F.size("w"), F.get("w", p)).otherwise(
        F.raise_error(F.lit("the model has no such cell")).cast("double")) * x)
    part = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)
    return (cells.join(blocks, ["block", "part"], "left").select("row", "y", part.alias("p"))
            .groupBy("row").agg(F.max("y").alias("y"), F.sum("p").alias("z")))


def score(rows: DataFrame, features: str, id_col: str, model: DataFrame, n_features: int,
          block_size: int = BLOCK_SIZE, parts: int = 1, out: str = "z") -> DataFrame:
    """``id, z`` of rows with an array column, by a model table of any size (never collected)."""
    cells = cells_of_arrays(rows.withColumn("_y", F.lit(0.0)), features, "_y", id_col, n_features, block_size)
    return predictor(cells, model, block_size, parts).select(F.col("row").alias(id_col), F.col("z").alias(out))


@dataclass
class BlockedResult:
    model: DataFrame                                     # class_idx, feature_idx, weight
    history: list[tuple] = field(default_factory=list)

    @property
    def converged(self) -> bool:
        return bool(self.history) and bool(self.history[-1][4])

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)


def train_gd_blocked(cells: DataFrame, n_features: int, cfg: GDConfig, init: DataFrame | None = None, *,
                     block_size: int = BLOCK_SIZE, parts: int | None = None, tasks: int | None = None,
                     on_epoch: Callable[[tuple], None] | None = None) -> BlockedResult:
    """Gradient descent over ``cells`` (``cells_of_arrays`` / ``cells_of_pairs`` of the same ``block_size``), with the stop tests and steps of
    :func:`~ridgeway.operators.gd.train_gd`.  ``parts``: tasks that share one block (default: the tasks
    of a shuffle over the number of blocks, at least 1)."""
    if cfg.max_epochs is None:
        raise ValueError("a blocked run needs an epoch limit")
    spark = cells.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = n_features // block_size + 1
    parts = parts or max(1, -(-2 * tasks // n_blocks))
    # two copies of the cells, each dealt once: no epoch moves a cell again
    kept, held = [], []
    for frame in (cells.withColumn("part", _part("row", parts)).repartition(tasks, "block", "part"),
                  cells.repartition(tasks, "row")):
        df, hold = materialize(frame, "persist" if cfg.materialize == "none" else cfg.materialize)
        kept.append(df)
        held.append(hold)
    by_block, by_row = kept
    bad = F.col("row").isNull() | F.col("y").isNull() | F.isnan("y") | F.exists("x", lambda v: v.isNull() | F.isnan(v))
    model = init if init is not None else zero_model(spark, n_features)
    result = BlockedResult(model)
    prev = math.inf
    try:
        first = F.col("block") == 0
        seen = by_block.agg(F.count(F.when(first, 1)).alias("n"), F.count(F.when(bad, 1)).alias("bad")).first()
        if seen["bad"]:
            raise ValueError("NULL or NaN in ids, features or label")
        if by_row.where(first).groupBy("row").count().where("count > 1").limit(1).count():
            raise ValueError("row ids are not unique")
        n = int(seen["n"])
        m = model.agg(F.count("weight").alias("n"), F.countDistinct("feature_idx").alias("k"), F.min("feature_idx").alias("lo"),
                      F.max("feature_idx").alias("hi"), F.max("class_idx").alias("c")).first()
        if (m["n"], m["k"], m["lo"], m["hi"], m["c"]) != (n_features + 1, n_features + 1, 0, n_features, 0):
            raise ValueError(f"the model table is not one class of {n_features + 1} cells")
        for epoch in itertools.count(1):
            if epoch > cfg.max_epochs:
                break
            z = predictor(by_block, model, block_size, parts)
            if cfg.loss == "squared":
                diff, term = F.col("z") - F.col("y"), (F.col("z") - F.col("y")) * (F.col("z") - F.col("y"))
            else:
                diff, term = sigmoid("z") - F.col("y"), logistic_nll("z", "y")
            factors = z.select("row", diff.alias("diff"), term.alias("term"))
            path = scratch_path(spark, "blocked-factors")
            factors.write.parquet(path)       # read twice below, and by tasks that are run again
            factors = spark.read.schema(factors.schema).parquet(path)
            loss = factors.agg(F.sum("term")).first()[0]
            loss = loss / n if n else float("nan")
            if cfg.l2:
                loss += cfg.l2 * model.where("feature_idx > 0").agg(F.sum(F.col("weight") * F.col("weight"))).first()[0]
            if not prev - loss > cfg.tol:
                result.history.append((epoch, n, float(loss), 0.0, True))
                if on_epoch:
                    on_epoch(result.history[-1])
                break
            pairs = F.arrays_zip("pos", "x")
            grad = (by_row.join(factors.select("row", "diff"), "row")
                    .select("block", "diff", F.inline(pairs))
                    .groupBy((F.col("block") * block_size + F.col("pos")).alias("feature_idx"))
                    .agg(F.sum(F.col("diff") * F.col("x")).alias("grad")))
            new = step_expression(F.col("weight"), F.coalesce("grad", F.lit(0.0)), F.lit(float(n)), F.col("feature_idx"),
                                  cfg.loss, cfg.lr, cfg.l2)
            path = scratch_path(spark, "blocked-model")
            (model.join(grad, "feature_idx", "left")
             .select("class_idx", "feature_idx", new.alias("weight"), F.col("weight").alias("old")).write.parquet(path))
            stepped = spark.read.parquet(path)
            delta = math.sqrt(stepped.agg(F.sum((F.col("weight") - F.col("old")) * (F.col("weight") - F.col("old")))).first()[0])
            model, prev = stepped.select("class_idx", "feature_idx", "weight"), loss
            result.model = model
            result.history.append((epoch, n, float(loss), delta, False))
            if on_epoch:
                on_epoch(result.history[-1])
    finally:
        for hold in held:
            release(hold)
    if not result.converged and cfg.tol >= 0:
        warnings.warn(f"gradient descent ended at max_epochs={cfg.max_epochs} before its stop test", stacklevel=2)
    return result
