"""Binary hinge queries over customer: margins, averaged SGD, scores, boundary lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.functions.linear import dot_then_bias, hinge_violation
from ridgeway.model import LinearModel
from ridgeway.operators.scoring import boundary_lines, decision_score
from ridgeway.operators.sgd import HINGE_DEFAULTS, HINGE_ETA_DEFAULTS, SGDConfig, model_delta_norm, models_table, train_sgd
from ridgeway.plans import sqlgen as S
from ridgeway.plans.registry import query, rnd, round_history, round_model
from ridgeway.sources.blobs import (TWO_BLOBS, UNIFORM_MULTIPLIERS, UNIFORM_PRIME, blob_table,
                                   union_class_tables)
from ridgeway.sources.tables import HINGE_FEATURES, hinge_rows

# Probe model for the scoring / boundary queries.
HINGE_PROBE = LinearModel([[0.8, -0.6]], [0.1])

# Rows of a shard in the registered trainers: small and fixed, so the number of shards
# follows the table at every size.
SHARD_ROWS = 400

# Registered trainer settings: the reference's binary-SVM constants
# (alpha .01, l 1, 20 passes, tol .001) and the re-aimed external estimator
# (step .1, penalty 1, 300 passes, tol .001).
SGD_HINGE = SGDConfig(**HINGE_DEFAULTS, rows_per_shard=SHARD_ROWS)
SGD_HINGE_ETA = SGDConfig(**HINGE_ETA_DEFAULTS, rows_per_shard=SHARD_ROWS)
# The same as SGD_HINGE with the rows dealt to the shards anew each pass, as the reference deals them.
SGD_HINGE_RESHARD = SGDConfig(**HINGE_DEFAULTS, rows_per_shard=SHARD_ROWS, reshard=True)
# A looser tolerance, so that the stop test ends the run (adopt, then stop).
SGD_HINGE_STOPS = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, rows_per_shard=SHARD_ROWS, max_iter=20, tol=0.05)
ONE_PASS = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, rows_per_shard=SHARD_ROWS, max_iter=1, tol=0.0, order="id")
AVG_PASS = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, rows_per_shard=SHARD_ROWS, max_iter=1, tol=0.0)
DELTA_RUN = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, rows_per_shard=SHARD_ROWS, max_iter=3, tol=0.0)

W_SQL = [S.num(v) for v in HINGE_PROBE.coef[0]]
B_SQL = S.num(HINGE_PROBE.intercept[0])
Z_SQL = S.dot_then_bias_sql(W_SQL, ["x1", "x2"], B_SQL)
ZERO = S.hinge_init([0.0, 0.0], 0.0)


def _st(cfg: SGDConfig):
    return S.sgd_state(cfg.kind, 1, 2, cfg.alpha, cfg.l2, cfg.fit_intercept)


def _sgd_sql(cfg: SGDConfig, init: str = ZERO) -> str:
    return S.sgd_model_sql(S.HINGE_ROWS, _st(cfg), S.shards_sql(cfg, S.HINGE_ROWS), cfg.max_iter, cfg.tol, cfg.order, init)


def _train(spark: SparkSession, sf: str, cfg: SGDConfig, init: LinearModel | None = None, **options):
    return train_sgd(hinge_rows(spark, sf), "id", HINGE_FEATURES, "y", cfg, init=init, **options)


@query("hinge_violations",
       f"SELECT id, {S.rnd(f'y * ({Z_SQL})', 9)} AS margin, y * ({Z_SQL}) < 1.0::DOUBLE AS violation "
       f"FROM ({S.HINGE_ROWS}) r")
def q_hinge_violations(spark: SparkSession, sf: str) -> DataFrame:
    z = dot_then_bias(HINGE_FEATURES, HINGE_PROBE.coef[0], HINGE_PROBE.intercept[0])
    t = hinge_rows(spark, sf).select("id", "y", z.alias("z"))
    return t.select("id", rnd(F.col("y") * F.col("z"), 9).alias("margin"),
                    hinge_violation("z", "y").alias("violation"))


@query("svm_decision_score", f"SELECT id, {S.rnd(Z_SQL, 9)} AS score FROM ({S.HINGE_ROWS}) r")
def q_svm_decision_score(spark: SparkSession, sf: str) -> DataFrame:
    t = decision_score(hinge_rows(spark, sf), HINGE_FEATURES, HINGE_PROBE)
    return t.select("id", rnd("score", 9).alias("score"))


def _line_sql(offset: float | None) -> str:
    num = f"-{B_SQL} - x1 * {W_SQL[0]}" if offset is None else f"{S.num(offset)} - {B_SQL} - x1 * {W_SQL[0]}"
    return S.rnd(f"({num}) / NULLIF({W_SQL[1]}, 0.0::DOUBLE)", 9)


@query("svm_boundary_line", f"SELECT id, x1, {_line_sql(None)} AS boundary FROM ({S.HINGE_ROWS}) r")
def q_svm_boundary_line(spark: SparkSession, sf: str) -> DataFrame:
    t = boundary_lines(hinge_rows(spark, sf), HINGE_FEATURES, HINGE_PROBE, {"boundary": 0.0})
    return t.select("id", "x1", rnd("boundary", 9).alias("boundary"))


@query("svm_margin_lines",
       f"SELECT id, x1, {_line_sql(1.0)} AS upper_margin, {_line_sql(-1.0)} AS lower_margin FROM ({S.HINGE_ROWS}) r")
def q_svm_margin_lines(spark: SparkSession, sf: str) -> DataFrame:
    t = boundary_lines(hinge_rows(spark, sf), HINGE_FEATURES, HINGE_PROBE,
                       {"upper_margin": 1.0, "lower_margin": -1.0})
    return t.select("id", "x1", rnd("upper_margin", 9).alias("upper_margin"),
                    rnd("lower_margin", 9).alias("lower_margin"))


@query("sgd_hinge", _sgd_sql(SGD_HINGE))
def q_sgd_hinge(spark: SparkSession, sf: str) -> DataFrame:
    return round_model(_train(spark, sf, SGD_HINGE).model_table(spark))


@query("sgd_hinge_stops",
       S.sgd_history_sql(S.HINGE_ROWS, _st(SGD_HINGE_STOPS), S.shards_sql(SGD_HINGE_STOPS, S.HINGE_ROWS),
                         SGD_HINGE_STOPS.max_iter, SGD_HINGE_STOPS.tol, SGD_HINGE_STOPS.order, ZERO))
def q_sgd_hinge_stops(spark: SparkSession, sf: str) -> DataFrame:
    """Every pass of a run that its stop test ends."""
    return round_history(_train(spark, sf, SGD_HINGE_STOPS).history_table(spark))


def run_sql(cfg: SGDConfig) -> str:
    return S.sgd_run_cte(S.HINGE_ROWS, cfg.kind, 1, 2, cfg.alpha, cfg.l2, S.shards_sql(cfg, S.HINGE_ROWS), cfg.max_iter, cfg.tol,
                         cfg.order, cfg.reshard)


@query("sgd_hinge_reshard", S.sgd_run_history_sql(run_sql(SGD_HINGE_RESHARD)))
def q_sgd_hinge_reshard(spark: SparkSession, sf: str) -> DataFrame:
    """Every pass of a run that deals the rows to the shards anew each pass (one exchange a pass)."""
    return round_history(_train(spark, sf, SGD_HINGE_RESHARD).history_table(spark))


@query("sgd_hinge_eta", S.sgd_run_model_sql(run_sql(SGD_HINGE_ETA)))
def q_sgd_hinge_eta(spark: SparkSession, sf: str) -> DataFrame:
    return round_model(_train(spark, sf, SGD_HINGE_ETA).model_table(spark))


@query("sgd_one_pass", _sgd_sql(ONE_PASS, S.hinge_init(HINGE_PROBE.coef[0], HINGE_PROBE.intercept[0])))
def q_sgd_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    """One partial-fit pass (rows by id inside each shard) from a given model."""
    return round_model(_train(spark, sf, ONE_PASS, init=HINGE_PROBE).model_table(spark))


@query("average_shard_models", _sgd_sql(AVG_PASS))
def q_average_shard_models(spark: SparkSession, sf: str) -> DataFrame:
    """One pass over the shards from zero, shard models averaged."""
    return round_model(_train(spark, sf, AVG_PASS).model_table(spark))


@query("model_delta_norm",
       S.sgd_chain_sql(S.HINGE_ROWS, _st(DELTA_RUN), S.shards_sql(DELTA_RUN, S.HINGE_ROWS), DELTA_RUN.max_iter, DELTA_RUN.tol,
                       DELTA_RUN.order, ZERO)
       + f"\nSELECT CAST(epoch AS INTEGER) AS epoch, {S.rnd('delta')} AS param_delta FROM models")
def q_model_delta_norm(spark: SparkSession, sf: str) -> DataFrame:
    """||model_e - model_{e-1}|| per epoch, from the stored model history (epoch 0 = start)."""
    res = _train(spark, sf, DELTA_RUN, keep_models=True)
    hist = models_table(spark, [LinearModel.zeros(1, 2), *res.models])
    return model_delta_norm(hist).select("epoch", rnd("param_delta").alias("param_delta"))


@query("union_class_tables",
       f"SELECT id, x1, x2, y FROM ({S.HINGE_ROWS}) r WHERE y < 0.0::DOUBLE UNION ALL "
       f"SELECT id, x1, x2, y FROM ({S.HINGE_ROWS}) r WHERE y > 0.0::DOUBLE")
def q_union_class_tables(spark: SparkSession, sf: str) -> DataFrame:
    rows = hinge_rows(spark, sf)
    return union_class_tables([rows.filter(F.col("y") < F.lit(0.0)), rows.filter(F.col("y") > F.lit(0.0))])


def _blob_sql() -> str:
    def u(dim: int) -> str:
        a = UNIFORM_MULTIPLIERS[dim % len(UNIFORM_MULTIPLIERS)]
        return (f"(CAST({S.pmod_sql(f'c_custkey * {a} + {dim * 31 + 17}', UNIFORM_PRIME)} AS DOUBLE) "
                f"/ {S.num(UNIFORM_PRIME)})")

    def per_class(vals) -> str:
        return ("CASE " + " ".join(f"WHEN {S.pmod_sql('c_custkey', len(vals))} = {c} THEN {S.num(v)}"
                                    for c, v in enumerate(vals[:-1])) + f" ELSE {S.num(vals[-1])} END")

    sc = per_class([b[0] for b in TWO_BLOBS])
    of = per_class([b[1] for b in TWO_BLOBS])
    lb = per_class([b[2] for b in TWO_BLOBS])
    return (f"SELECT c_custkey AS id, {S.rnd(f'{sc} * {u(0)} + {of}', 9)} AS x1, "
            f"{S.rnd(f'{sc} * {u(1)} + {of}', 9)} AS x2, {lb} AS y FROM customer")


@query("blob_table", _blob_sql())
def q_blob_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two labelled 2-D blobs, one point per customer key."""
    keys = hinge_rows(spark, sf).select("id")
    b = blob_table(keys, "id", TWO_BLOBS)
    return b.select("id", rnd("x1", 9).alias("x1"), rnd("x2", 9).alias("x2"), "y")
