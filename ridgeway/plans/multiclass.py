"""K-class queries over embeddings (K=10, d=64): feature table, labels, scores,
margins, probabilities, predictions, accuracy and the two averaged-SGD trainers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.functions.multiclass import (hinge_coefficients, multiclass_margins, one_hot)
from ridgeway.model import LinearModel
from ridgeway.operators.scoring import (accuracy, ranked_classes, with_class_scores,
                                        with_prediction, with_probabilities)
from ridgeway.operators.sample import first_n_by
from ridgeway.operators.sgd import MULTICLASS_HINGE_DEFAULTS, SOFTMAX_DEFAULTS, SGDConfig, train_sgd
from ridgeway.plans import sqlgen as S
from ridgeway.plans.registry import query, rnd, round_history, round_model
from ridgeway.sources.tables import class_rows

K, D = 10, 64


def _probe() -> LinearModel:
    """Deterministic K x d probe weights from an integer rule."""
    coef = [[(((k * 7 + j * 3) % 11) - 5) / 50.0 for j in range(D)] for k in range(K)]
    return LinearModel(coef, [(k - 4.5) / 10.0 for k in range(K)])


MC_PROBE = _probe()

# Registered trainer settings: the reference's step sizes, penalties, tolerances and pass limits (250
# and 450), over shards of SHARD_ROWS rows (as many as the table needs).
SHARD_ROWS = 150
SGD_MULTI = SGDConfig(**MULTICLASS_HINGE_DEFAULTS, rows_per_shard=SHARD_ROWS)
SGD_SOFTMAX = SGDConfig(**SOFTMAX_DEFAULTS, rows_per_shard=SHARD_ROWS)

W_LIST = "[" + ", ".join(S.num(v) for v in MC_PROBE.coef.reshape(-1)) + "]"
B_LIST = "[" + ", ".join(S.num(v) for v in MC_PROBE.intercept) + "]"
SCORES_SQL = (f"list_transform(range(0, {K}), lambda k: list_dot_product(list_slice({W_LIST}, k * {D} + 1, "
              f"k * {D} + {D}), features) + {B_LIST}[k + 1])")
SCORED_SQL = f"SELECT id, label, features, {SCORES_SQL} AS s FROM ({S.CLASS_ROWS}) r"


def _scored(spark: SparkSession, sf: str, model: LinearModel = MC_PROBE) -> DataFrame:
    return with_class_scores(class_rows(spark, sf), "features", model)


def _long(df: DataFrame, arr: str, name: str, digits: int = 6) -> DataFrame:
    return (df.select("id", F.posexplode(arr).alias("class_idx", "v"))
              .select("id", F.col("class_idx").cast("int"), rnd("v", digits).alias(name)))


def _long_sql(src: str, arr: str, name: str, digits: int = 6) -> str:
    return (f"SELECT id, CAST(i - 1 AS INTEGER) AS class_idx, {S.rnd('v', digits)} AS {name} FROM "
            f"(SELECT id, unnest({arr}) AS v, unnest(range(1, len({arr}) + 1)) AS i FROM ({src}) q) u")


# ---- feature table, labels -----------------------------------------------

@query("scan_feature_table",
       f"SELECT id, label, CAST(len(features) AS INTEGER) AS n_features, "
       f"{S.rnd('sqrt(list_sum(list_transform(features, lambda v: v * v)))')} AS f_norm FROM ({S.CLASS_ROWS}) r")
def q_scan_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = class_rows(spark, sf)
    sq = F.aggregate(F.transform("features", lambda v: v * v), F.lit(0.0), lambda a, v: a + v)
    return rows.select("id", "label", F.size("features").cast("int").alias("n_features"),
                       rnd(F.sqrt(sq)).alias("f_norm"))


# Smaller than the table at every scale, so that the limit cuts.
SAMPLE_ROWS = 400


@query("train_sample_limit", f"SELECT id, label FROM ({S.CLASS_ROWS}) r ORDER BY id LIMIT {SAMPLE_ROWS}")
def q_train_sample_limit(spark: SparkSession, sf: str) -> DataFrame:
    """The first labelled rows by id (the reference takes 10,000 of a larger table)."""
    return first_n_by(class_rows(spark, sf).select("id", "label"), "id", SAMPLE_ROWS)


@query("append_label",
       f"SELECT id, CAST(len(features) + 1 AS INTEGER) AS row_len, features[1] AS first_value, "
       f"CAST(label AS DOUBLE) AS last_value FROM ({S.CLASS_ROWS}) r")
def q_append_label(spark: SparkSession, sf: str) -> DataFrame:
    rows = class_rows(spark, sf)
    full = F.concat(F.col("features"), F.array(F.col("label").cast("double")))
    t = rows.select("id", full.alias("row"))
    return t.select("id", F.size("row").cast("int").alias("row_len"),
                    F.element_at("row", 1).alias("first_value"),
                    F.element_at("row", -1).alias("last_value"))


@query("split_label_last",
       f"SELECT id, label, CAST(len(features) AS INTEGER) AS n_features, features[1] AS first_feature, "
       f"features[len(features)] AS last_feature FROM ({S.CLASS_ROWS}) r")
def q_split_label_last(spark: SparkSession, sf: str) -> DataFrame:
    """Rows stored as [features..., label] split back into features and an int label."""
    rows = class_rows(spark, sf)
    t = rows.select("id", F.concat(F.col("features"), F.array(F.col("label").cast("double"))).alias("row"))
    feats = F.slice(F.col("row"), 1, F.size("row") - 1)
    s = t.select("id", feats.alias("f"), F.element_at("row", -1).cast("int").alias("label"))
    return s.select("id", "label", F.size("f").cast("int").alias("n_features"),
                    F.element_at("f", 1).alias("first_feature"), F.element_at("f", -1).alias("last_feature"))


@query("class_count", f"SELECT CAST(count(DISTINCT label) AS BIGINT) AS n_classes FROM ({S.CLASS_ROWS}) r")
def q_class_count(spark: SparkSession, sf: str) -> DataFrame:
    return class_rows(spark, sf).agg(F.countDistinct("label").alias("n_classes"))


def _n_classes(rows: DataFrame) -> int:
    return int(rows.agg(F.countDistinct("label")).collect()[0][0])


@query("one_hot_labels",
       f"SELECT id, CAST(k AS INTEGER) AS class_idx, CASE WHEN k = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
       f"AS indicator FROM (SELECT id, label, unnest(range(0, (SELECT count(DISTINCT label) FROM embeddings))) "
       f"AS k FROM ({S.CLASS_ROWS}) r) u")
def q_one_hot_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = class_rows(spark, sf)
    oh = rows.select("id", one_hot("label", _n_classes(rows)).alias("oh"))
    return _long(oh, "oh", "indicator")


@query("init_model",
       "SELECT CAST(k AS INTEGER) AS class_idx, CAST(j AS INTEGER) AS feature_idx, 0.0::DOUBLE AS weight FROM "
       f"(SELECT unnest(range(0, nk)) AS k, nd FROM (SELECT count(DISTINCT label) AS nk, max(len(features)) AS nd "
       f"FROM ({S.CLASS_ROWS}) r) a) b, LATERAL (SELECT unnest(range(0, nd + 1)) AS j) c")
def q_init_model(spark: SparkSession, sf: str) -> DataFrame:
    """Zero K x (d+1) model whose shape is read from the data (K distinct labels, d features)."""
    dims = class_rows(spark, sf).agg(F.countDistinct("label").alias("k"), F.max(F.size("features")).alias("d"))
    cls = dims.select(F.explode(F.sequence(F.lit(0), F.col("k").cast("int") - 1)).alias("class_idx"), "d")
    cells = cls.select("class_idx", F.explode(F.sequence(F.lit(0), F.col("d"))).alias("feature_idx"))
    return cells.select(F.col("class_idx").cast("int"), F.col("feature_idx").cast("int"),
                        F.lit(0.0).alias("weight"))


# ---- scores, margins, probabilities, predictions --------------------------

@query("multiclass_scores", _long_sql(SCORED_SQL, "s", "score"))
def q_multiclass_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _long(_scored(spark, sf), "scores", "score")


_MARGIN_SQL = (f"SELECT id, label, list_transform(s, lambda v, k: CASE WHEN k = label + 1 THEN 0.0::DOUBLE "
               f"ELSE v - s[label + 1] + 1.0::DOUBLE END) AS m FROM ({SCORED_SQL}) q")
_COEF_SQL = (f"SELECT id, m, list_transform(m, lambda v, k: CASE WHEN k = label + 1 THEN "
             f"-CAST(len(list_filter(m, lambda u: u > 0.0::DOUBLE)) AS DOUBLE) "
             f"ELSE CAST(v > 0.0::DOUBLE AS DOUBLE) END) AS c FROM ({_MARGIN_SQL}) q2")


@query("multiclass_margins",
       f"SELECT id, CAST(i - 1 AS INTEGER) AS class_idx, {S.rnd('mv')} AS margin, cv AS coef FROM "
       f"(SELECT id, unnest(m) AS mv, unnest(c) AS cv, unnest(range(1, len(m) + 1)) AS i FROM ({_COEF_SQL}) q3) u")
def q_multiclass_margins(spark: SparkSession, sf: str) -> DataFrame:
    s = _scored(spark, sf)
    m = s.select("id", "label", multiclass_margins("scores", "label").alias("m"))
    c = m.select("id", "m", hinge_coefficients("m", "label").alias("c"))
    z = c.select("id", F.posexplode(F.arrays_zip("m", "c")).alias("class_idx", "mc"))
    return z.select("id", F.col("class_idx").cast("int"), rnd("mc.m").alias("margin"), F.col("mc.c").alias("coef"))


_PROBS_SQL = (f"SELECT id, label, list_transform(e, lambda v: v / list_sum(e)) AS p FROM "
              f"(SELECT id, label, list_transform(s, lambda v: exp(v - list_max(s))) AS e FROM ({SCORED_SQL}) q) q2")


@query("softmax_probs", _long_sql(_PROBS_SQL, "p", "prob"))
def q_softmax_probs(spark: SparkSession, sf: str) -> DataFrame:
    return _long(with_probabilities(_scored(spark, sf)), "probs", "prob")


@query("predict_class",
       f"SELECT id, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS prediction FROM ({SCORED_SQL}) q")
def q_predict_class(spark: SparkSession, sf: str) -> DataFrame:
    return with_prediction(_scored(spark, sf)).select("id", "prediction")


@query("predict_class_ranked",
       f"SELECT id, class_idx, score, CAST(row_number() OVER (PARTITION BY id ORDER BY score_raw DESC, class_idx) "
       f"AS INTEGER) AS class_rank FROM (SELECT id, CAST(i - 1 AS INTEGER) AS class_idx, v AS score_raw, "
       f"{S.rnd('v')} AS score FROM (SELECT id, unnest(s) AS v, unnest(range(1, len(s) + 1)) AS i "
       f"FROM ({SCORED_SQL}) q) u) w")
def q_predict_class_ranked(spark: SparkSession, sf: str) -> DataFrame:
    r = ranked_classes(_scored(spark, sf), "id")
    return r.select("id", "class_idx", rnd("score").alias("score"), "class_rank")


# ---- trainers --------------------------------------------------------------

def run_sql(cfg: SGDConfig) -> str:
    return S.sgd_run_cte(S.CLASS_ROWS, cfg.kind, K, D, cfg.alpha, cfg.l2, S.shards_sql(cfg, S.CLASS_ROWS), cfg.max_iter, cfg.tol,
                         cfg.order, cfg.reshard)


ACCURACY_SQL = (f"SELECT {S.rnd('avg(CAST(list_position(s, list_max(s)) - 1 = label AS DOUBLE))')} AS accuracy FROM "
                f"(SELECT r.label, list_transform(f.m, lambda c: list_dot_product(c[2:], r.features) + c[1]) AS s "
                f"FROM ({S.CLASS_ROWS}) r, final f) q")


def _train(spark: SparkSession, sf: str, cfg: SGDConfig):
    return train_sgd(class_rows(spark, sf), "id", "features", "label", cfg)


@query("sgd_multiclass_hinge", S.sgd_run_model_sql(run_sql(SGD_MULTI)))
def q_sgd_multiclass_hinge(spark: SparkSession, sf: str) -> DataFrame:
    return round_model(_train(spark, sf, SGD_MULTI).model_table(spark))


@query("sgd_softmax", S.sgd_run_model_sql(run_sql(SGD_SOFTMAX)))
def q_sgd_softmax(spark: SparkSession, sf: str) -> DataFrame:
    return round_model(_train(spark, sf, SGD_SOFTMAX).model_table(spark))


@query("sgd_softmax_history", S.sgd_run_history_sql(run_sql(SGD_SOFTMAX)))
def q_sgd_softmax_history(spark: SparkSession, sf: str) -> DataFrame:
    return round_history(_train(spark, sf, SGD_SOFTMAX).history_table(spark))


@query("multiclass_accuracy", run_sql(SGD_SOFTMAX) + "\n" + ACCURACY_SQL)
def q_multiclass_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Training accuracy of the averaged-SGD softmax model."""
    model = _train(spark, sf, SGD_SOFTMAX).model
    pred = with_prediction(_scored(spark, sf, model))
    return accuracy(pred).select(rnd("accuracy").alias("accuracy"))
