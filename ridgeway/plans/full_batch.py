"""Full-batch queries over lineitem: expressions, gradients, losses, steps, GD trainers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.functions.linear import linear_predictor, logistic_nll, sigmoid
from ridgeway.model import LinearModel
from ridgeway.operators.blocked import cells_of_arrays, train_gd_blocked
from ridgeway.operators.blocked import score as score_blocked
from ridgeway.operators.gd import (LINEAR_DEFAULTS, LINEAR_L2_DEFAULTS, LOGISTIC_DEFAULTS,
                                   LOGISTIC_LR02_DEFAULTS, GDConfig, train_gd)
from ridgeway.operators.gradient import (gradient_long_form, gradient_stats, gradient_step_join,
                                         gradient_table, l2_penalty, loss_summary)
from ridgeway.operators.scoring import score_with_model_table
from ridgeway.plans import sqlgen as S
from ridgeway.plans.registry import query, rnd, round_history, round_model
from ridgeway.session import scratch_path
from ridgeway.sources.tables import LIN_FEATURES, class_rows, lin_rows, log_rows
from ridgeway.sources.text import read_weight_lines, write_weight_lines

# Probe weights [w0 (intercept), w1, w2, w3] for the expression queries.
LIN_PROBE = [0.05, 0.4, -0.3, 0.2]
LOG_PROBE = [-0.5, 1.2, -0.8, 0.6]
STEP_LR, STEP_L2 = 0.1, 0.001

# Trainer settings of the registered GD queries: the reference's own constants.
GD_LINEAR_L2 = GDConfig(**LINEAR_L2_DEFAULTS, max_epochs=1000)
GD_LINEAR = GDConfig(**LINEAR_DEFAULTS, max_epochs=None)   # some 10^4 epochs, to the stop test
# One scan per epoch instead of the one-pass statistics; a larger step keeps the epochs few.
GD_LINEAR_EPOCHS = GDConfig(loss="squared", lr=0.1, l2=0.001, tol=1e-3, max_epochs=200, method="direct")
# 64 features in one array column: Arrow partial vectors.
GD_WIDE = GDConfig(loss="squared", lr=0.05, l2=0.001, tol=1e-4, max_epochs=40)
WIDE = 64
# The same features from one pass: Gram statistics by Arrow batches, then every epoch on the driver.
GD_WIDE_GRAM = GDConfig(loss="squared", lr=0.05, l2=0.0, tol=1e-6, max_epochs=None)
# And with the model in blocks of 16 cells, which no task and no driver holds whole; a larger step keeps the epochs few.
GD_BLOCKED = GDConfig(loss="squared", lr=0.3, l2=0.001, tol=5e-4, max_epochs=1000)
BLOCK = 16
GD_LOGISTIC = GDConfig(**LOGISTIC_DEFAULTS, max_epochs=1000)
GD_LOGISTIC_LR02 = GDConfig(**LOGISTIC_LR02_DEFAULTS, max_epochs=1000)

ID = "l_orderkey, l_linenumber"
W_LIN = [S.num(v) for v in LIN_PROBE]
W_LOG = [S.num(v) for v in LOG_PROBE]
XS = ["x1", "x2", "x3"]


def _stats_sql(rows_sql: str, w: list[str], loss: str) -> str:
    """One-row n, ls, g0..g3 at fixed weights."""
    z = S.linear_sql(w, XS)
    if loss == "squared":
        t = "(z - y) AS diff, (z - y) * (z - y) AS lt"
    else:
        t = f"(1.0::DOUBLE / (1.0::DOUBLE + exp(-z)) - y) AS diff, {S.nll_sql('z', 'y')} AS lt"
    return (f"SELECT count(*) AS n, sum(lt) AS ls, sum(diff) AS g0, "
            + ", ".join(f"sum(diff * x{i}) AS g{i}" for i in range(1, 4))
            + f" FROM (SELECT x1, x2, x3, {t} FROM (SELECT y, x1, x2, x3, {z} AS z FROM ({rows_sql}) r0) r1) r2")


def _grad_table_sql(stats: str, digits: int = 3) -> str:
    return " UNION ALL ".join(
        f"SELECT 0::INTEGER AS class_idx, {i}::INTEGER AS feature_idx, {S.rnd(f'g{i}', digits)} AS grad, "
        f"n AS n_rows FROM ({stats}) st" for i in range(4))


def _step_sql() -> str:
    """One-row s0..s3: one squared-loss L2 step from LIN_PROBE."""
    st = _stats_sql(S.LIN_ROWS, W_LIN, "squared")
    lr, l2 = S.num(STEP_LR), S.num(STEP_L2)
    cols = [f"{W_LIN[0]} - 2.0::DOUBLE * {lr} * g0 / n AS s0"] + [
        f"{W_LIN[i]} - (2.0::DOUBLE * {lr} * g{i} / n + 2.0::DOUBLE * {l2} * {W_LIN[i]}) AS s{i}"
        for i in range(1, 4)]
    return f"SELECT {', '.join(cols)} FROM ({st}) st"


def _probe_model(spark: SparkSession, w: list[float]) -> DataFrame:
    return LinearModel.from_vector(w).to_table(spark)


# ---- expressions ---------------------------------------------------------

@query("linear_predictor", f"SELECT {ID}, y, {S.rnd(S.linear_sql(W_LIN, XS), 9)} AS z FROM ({S.LIN_ROWS}) r")
def q_linear_predictor(spark: SparkSession, sf: str) -> DataFrame:
    z = linear_predictor(LIN_FEATURES, LIN_PROBE[1:], LIN_PROBE[0])
    return lin_rows(spark, sf).select("l_orderkey", "l_linenumber", "y", rnd(z, 9).alias("z"))


@query("residuals",
       f"SELECT {ID}, {S.rnd('z - y', 9)} AS residual, {S.rnd('(z - y) * (z - y)', 12)} AS sq_error "
       f"FROM (SELECT *, {S.linear_sql(W_LIN, XS)} AS z FROM ({S.LIN_ROWS}) r) q")
def q_residuals(spark: SparkSession, sf: str) -> DataFrame:
    z = linear_predictor(LIN_FEATURES, LIN_PROBE[1:], LIN_PROBE[0])
    r = lin_rows(spark, sf).select("l_orderkey", "l_linenumber", (z - F.col("y")).alias("r"))
    # residuals have 7 exact decimals, their squares 14: 9 / 12 decimals never sit on a tie
    return r.select("l_orderkey", "l_linenumber", rnd("r", 9).alias("residual"),
                    rnd(F.col("r") * F.col("r"), 12).alias("sq_error"))


@query("sigmoid_scores",
       f"SELECT {ID}, y, {S.rnd('z')} AS z, {S.rnd('1.0::DOUBLE / (1.0::DOUBLE + exp(-z))')} AS prob "
       f"FROM (SELECT *, {S.linear_sql(W_LOG, XS)} AS z FROM ({S.LOG_ROWS}) r) q")
def q_sigmoid_scores(spark: SparkSession, sf: str) -> DataFrame:
    z = linear_predictor(LIN_FEATURES, LOG_PROBE[1:], LOG_PROBE[0])
    t = log_rows(spark, sf).select("l_orderkey", "l_linenumber", "y", z.alias("z"))
    return t.select("l_orderkey", "l_linenumber", "y", rnd("z").alias("z"), rnd(sigmoid("z")).alias("prob"))


@query("logistic_nll_rows",
       f"SELECT {ID}, y, {S.rnd(S.nll_sql('z', 'y'))} AS nll "
       f"FROM (SELECT *, {S.linear_sql(W_LOG, XS)} AS z FROM ({S.LOG_ROWS}) r) q")
def q_logistic_nll_rows(spark: SparkSession, sf: str) -> DataFrame:
    z = linear_predictor(LIN_FEATURES, LOG_PROBE[1:], LOG_PROBE[0])
    t = log_rows(spark, sf).select("l_orderkey", "l_linenumber", "y", z.alias("z"))
    return t.select("l_orderkey", "l_linenumber", "y", rnd(logistic_nll("z", "y")).alias("nll"))


@query("split_label_first", f"SELECT {ID}, y AS label, x1, x2, x3, 3::INTEGER AS n_features FROM ({S.LIN_ROWS}) r")
def q_split_label_first(spark: SparkSession, sf: str) -> DataFrame:
    """Tab-joined lines (label first) split back into label and features."""
    rows = lin_rows(spark, sf)
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in ["y", *LIN_FEATURES]])
    toks = F.split(line, "\t")
    feats = F.slice(toks, 2, F.size(toks) - 1)
    t = rows.select("l_orderkey", "l_linenumber", toks.getItem(0).cast("double").alias("label"),
                    feats.alias("f"))
    return t.select("l_orderkey", "l_linenumber", "label",
                    *[F.col("f").getItem(i).cast("double").alias(f"x{i + 1}") for i in range(3)],
                    F.size("f").cast("int").alias("n_features"))


# ---- gradients, losses, steps ---------------------------------------------

@query("linear_gradient", _grad_table_sql(_stats_sql(S.LIN_ROWS, W_LIN, "squared")))
def q_linear_gradient(spark: SparkSession, sf: str) -> DataFrame:
    g = gradient_table(gradient_stats(lin_rows(spark, sf), LIN_FEATURES, "y", LIN_PROBE, "squared"), 3)
    return g.select("class_idx", "feature_idx", rnd("grad", 3).alias("grad"), "n_rows")


@query("gradient_long_form", _grad_table_sql(_stats_sql(S.LIN_ROWS, W_LIN, "squared")))
def q_gradient_long_form(spark: SparkSession, sf: str) -> DataFrame:
    g = gradient_long_form(lin_rows(spark, sf), LIN_FEATURES, "y", LIN_PROBE, "squared")
    return g.select("class_idx", "feature_idx", rnd("grad", 3).alias("grad"), "n_rows")


@query("logistic_gradient", _grad_table_sql(_stats_sql(S.LOG_ROWS, W_LOG, "logistic")))
def q_logistic_gradient(spark: SparkSession, sf: str) -> DataFrame:
    g = gradient_table(gradient_stats(log_rows(spark, sf), LIN_FEATURES, "y", LOG_PROBE, "logistic"), 3)
    return g.select("class_idx", "feature_idx", rnd("grad", 3).alias("grad"), "n_rows")


@query("loss_summary",
       "SELECT 'squared' AS loss, n AS n_rows, " + S.rnd("ls", 3) + " AS loss_sum, " + S.rnd("ls / n")
       + f" AS mean_loss FROM ({_stats_sql(S.LIN_ROWS, W_LIN, 'squared')}) a UNION ALL "
       "SELECT 'logistic' AS loss, n AS n_rows, " + S.rnd("ls", 3) + " AS loss_sum, " + S.rnd("ls / n")
       + f" AS mean_loss FROM ({_stats_sql(S.LOG_ROWS, W_LOG, 'logistic')}) b")
def q_loss_summary(spark: SparkSession, sf: str) -> DataFrame:
    sq = loss_summary(lin_rows(spark, sf), LIN_FEATURES, "y", LIN_PROBE)
    lg = loss_summary(log_rows(spark, sf), LIN_FEATURES, "y", LOG_PROBE)
    return sq.select(F.lit("squared").alias("loss"), "n_rows", rnd("sse", 3).alias("loss_sum"),
                     rnd("mse").alias("mean_loss")).unionByName(
        lg.select(F.lit("logistic").alias("loss"), "n_rows", rnd("nll_sum", 3).alias("loss_sum"),
                  rnd("mean_nll").alias("mean_loss")))


def _step_model(spark: SparkSession, sf: str) -> DataFrame:
    grad = gradient_table(gradient_stats(lin_rows(spark, sf), LIN_FEATURES, "y", LIN_PROBE, "squared"), 3)
    return gradient_step_join(grad, _probe_model(spark, LIN_PROBE), "squared", STEP_LR, STEP_L2,
                              model_cells=len(LIN_PROBE))


@query("gradient_step_join", S.model_rows_sql(f"({_step_sql()})", ["s0", "s1", "s2", "s3"]))
def q_gradient_step_join(spark: SparkSession, sf: str) -> DataFrame:
    return round_model(_step_model(spark, sf))


@query("l2_penalty", f"SELECT {S.rnd(f'{S.num(STEP_L2)} * (s1 * s1 + s2 * s2 + s3 * s3)', 9)} AS l2_penalty "
                     f"FROM ({_step_sql()}) st")
def q_l2_penalty(spark: SparkSession, sf: str) -> DataFrame:
    return l2_penalty(_step_model(spark, sf), STEP_L2).select(rnd("l2_penalty", 9).alias("l2_penalty"))


@query("score_with_model_table",
       f"SELECT {ID}, {S.rnd(S.linear_sql(['s0', 's1', 's2', 's3'], XS))} AS z "
       f"FROM ({S.LIN_ROWS}) r, ({_step_sql()}) st")
def q_score_with_model_table(spark: SparkSession, sf: str) -> DataFrame:
    scored = score_with_model_table(lin_rows(spark, sf), LIN_FEATURES, _step_model(spark, sf))
    return scored.select("l_orderkey", "l_linenumber", rnd("z").alias("z"))


# ---- trainers ------------------------------------------------------------

_ZERO = ["0.0::DOUBLE"] * 4


def _gd_sql(rows_sql: str, cfg: GDConfig, init=_ZERO) -> str:
    if cfg.max_epochs is None:
        return S.gd_gram_cte(rows_sql, 3, cfg.lr, cfg.l2, cfg.tol, init)
    return S.gd_cte(rows_sql, 3, cfg.loss, cfg.lr, cfg.l2, cfg.tol, cfg.max_epochs, init)


@query("gd_linear_l2", S.gd_model_sql(_gd_sql(S.LIN_ROWS, GD_LINEAR_L2), 3))
def q_gd_linear_l2(spark: SparkSession, sf: str) -> DataFrame:
    res = train_gd(lin_rows(spark, sf), LIN_FEATURES, "y", GD_LINEAR_L2)
    return round_model(res.model_table(spark))


@query("gd_linear", S.gd_model_sql(_gd_sql(S.LIN_ROWS, GD_LINEAR), 3))
def q_gd_linear(spark: SparkSession, sf: str) -> DataFrame:
    res = train_gd(lin_rows(spark, sf), LIN_FEATURES, "y", GD_LINEAR)
    return round_model(res.model_table(spark))


@query("gd_linear_epochs", S.gd_history_sql(_gd_sql(S.LIN_ROWS, GD_LINEAR_EPOCHS)))
def q_gd_linear_epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Squared loss by one gradient aggregate per epoch, epoch by epoch."""
    res = train_gd(lin_rows(spark, sf), LIN_FEATURES, "y", GD_LINEAR_EPOCHS)
    return round_history(res.history_table(spark))


_WIDE_ROWS = (f"SELECT label / 10.0::DOUBLE AS y, {', '.join(f'features[{i}] AS x{i}' for i in range(1, WIDE + 1))} "
              f"FROM ({S.CLASS_ROWS}) wide")


@query("gd_wide_array", S.gd_model_sql(
    S.gd_cte(_WIDE_ROWS, WIDE, GD_WIDE.loss, GD_WIDE.lr, GD_WIDE.l2, GD_WIDE.tol, GD_WIDE.max_epochs, ["0.0::DOUBLE"] * (WIDE + 1)), WIDE))
def q_gd_wide_array(spark: SparkSession, sf: str) -> DataFrame:
    """Squared loss over the embeddings' array column (a tenth of the label as the target)."""
    rows = class_rows(spark, sf).select("features", (F.col("label") / F.lit(10.0)).alias("y"))
    return round_model(train_gd(rows, "features", "y", GD_WIDE, n_features=WIDE).model_table(spark))


@query("gd_wide_gram", S.gd_model_sql(
    S.gd_gram_cte(_WIDE_ROWS, WIDE, GD_WIDE_GRAM.lr, GD_WIDE_GRAM.l2, GD_WIDE_GRAM.tol, ["0.0::DOUBLE"] * (WIDE + 1)), WIDE))
def q_gd_wide_gram(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows by one pass of Gram statistics over the array column, trained to the stop test."""
    rows = class_rows(spark, sf).select("features", (F.col("label") / F.lit(10.0)).alias("y"))
    return round_model(train_gd(rows, "features", "y", GD_WIDE_GRAM, n_features=WIDE).model_table(spark))


@query("gd_blocked", S.gd_model_sql(
    S.gd_cte(_WIDE_ROWS, WIDE, GD_BLOCKED.loss, GD_BLOCKED.lr, GD_BLOCKED.l2, GD_BLOCKED.tol, GD_BLOCKED.max_epochs, ["0.0::DOUBLE"] * (WIDE + 1)), WIDE))
def q_gd_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows with the model partitioned by feature block: its cells never reach the driver."""
    rows = class_rows(spark, sf).select("id", "features", (F.col("label") / F.lit(10.0)).alias("y"))
    cells = cells_of_arrays(rows, "features", "y", "id", WIDE, BLOCK)
    return round_model(train_gd_blocked(cells, WIDE, GD_BLOCKED, block_size=BLOCK).model)


@query("score_blocked", f"SELECT id, {S.rnd(S.linear_sql([S.num(j / 100.0 - 0.3) for j in range(WIDE + 1)], [f'features[{i}]' for i in range(1, WIDE + 1)]))} AS z "
                        f"FROM ({S.CLASS_ROWS}) wide")
def q_score_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """Scores by a model table that is joined by feature block, whatever its size."""
    model = spark.range(WIDE + 1).select(F.lit(0).alias("class_idx"), F.col("id").cast("int").alias("feature_idx"),
                                         (F.col("id") / F.lit(100.0) - F.lit(0.3)).alias("weight"))
    z = score_blocked(class_rows(spark, sf), "features", "id", model, WIDE, block_size=BLOCK)
    return z.select("id", rnd("z").alias("z"))


@query("gd_logistic", S.gd_model_sql(_gd_sql(S.LOG_ROWS, GD_LOGISTIC), 3))
def q_gd_logistic(spark: SparkSession, sf: str) -> DataFrame:
    res = train_gd(log_rows(spark, sf), LIN_FEATURES, "y", GD_LOGISTIC)
    return round_model(res.model_table(spark))


@query("gd_logistic_lr02", S.gd_model_sql(_gd_sql(S.LOG_ROWS, GD_LOGISTIC_LR02), 3))
def q_gd_logistic_lr02(spark: SparkSession, sf: str) -> DataFrame:
    res = train_gd(log_rows(spark, sf), LIN_FEATURES, "y", GD_LOGISTIC_LR02)
    return round_model(res.model_table(spark))


@query("gd_logistic_history", S.gd_history_sql(_gd_sql(S.LOG_ROWS, GD_LOGISTIC)))
def q_gd_logistic_history(spark: SparkSession, sf: str) -> DataFrame:
    res = train_gd(log_rows(spark, sf), LIN_FEATURES, "y", GD_LOGISTIC)
    return round_history(res.history_table(spark))


@query("gd_warm_start", S.gd_model_sql(_gd_sql(S.LOG_ROWS, GD_LOGISTIC, W_LOG), 3))
def q_gd_warm_start(spark: SparkSession, sf: str) -> DataFrame:
    """Logistic GD whose initial weights are read from a stored weight-lines file."""
    path = scratch_path(spark, "warm-start")
    write_weight_lines(_probe_model(spark, LOG_PROBE), path)
    init = LinearModel.from_table(read_weight_lines(spark, path))
    res = train_gd(log_rows(spark, sf), LIN_FEATURES, "y", GD_LOGISTIC, init=init)
    return round_model(res.model_table(spark))
