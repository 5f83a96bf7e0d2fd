"""Properties of the GD and averaged-SGD trainers on the provided tables."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeway.model import LinearModel
from ridgeway.operators.folds import ShardState, fold_hinge
from ridgeway.operators.gd import GDConfig, train_gd
from ridgeway.operators.sgd import SGDConfig, train_sgd
from ridgeway.sources.tables import HINGE_FEATURES, LIN_FEATURES, hinge_rows, lin_rows, log_rows
from tests.conftest import SF_SMALL


def test_gram_path_equals_direct_path(spark):
    rows = lin_rows(spark, SF_SMALL)
    a = train_gd(rows, LIN_FEATURES, "y", GDConfig(lr=0.1, l2=0.001, tol=1e-3, method="gram"))
    b = train_gd(rows, LIN_FEATURES, "y", GDConfig(lr=0.1, l2=0.001, tol=1e-3, method="direct"))
    assert len(a.history) == len(b.history)
    np.testing.assert_allclose(a.model.vector(), b.model.vector(), rtol=1e-10, atol=1e-12)


def test_gd_is_row_order_invariant(spark):
    rows = log_rows(spark, SF_SMALL)
    cfg = GDConfig(loss="logistic", lr=0.5, tol=1e-4, max_epochs=30)
    a = train_gd(rows, LIN_FEATURES, "y", cfg)
    b = train_gd(rows.repartition(7).orderBy(F.rand(3)), LIN_FEATURES, "y", cfg)
    np.testing.assert_allclose(a.model.vector(), b.model.vector(), rtol=1e-9, atol=1e-12)


def test_zero_step_is_a_fixed_point_and_stops(spark):
    res = train_gd(log_rows(spark, SF_SMALL), LIN_FEATURES, "y",
                   GDConfig(loss="logistic", lr=0.0, tol=1e-6), init=[0.1, 0.2, 0.3, 0.4])
    assert [h[4] for h in res.history] == [False, True]
    np.testing.assert_array_equal(res.model.vector(), [0.1, 0.2, 0.3, 0.4])


def test_linear_gd_reaches_least_squares(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rows = lin_rows(spark, SF_SMALL)
    res = train_gd(rows, LIN_FEATURES, "y", GDConfig(lr=0.5, tol=1e-14, max_epochs=20000))
    va = VectorAssembler(inputCols=LIN_FEATURES, outputCol="f")
    lr = LinearRegression(featuresCol="f", labelCol="y", regParam=0.0, standardization=False,
                          solver="normal").fit(va.transform(rows))
    np.testing.assert_allclose(res.model.coef[0], lr.coefficients.toArray(), atol=2e-3)
    assert res.model.intercept[0] == pytest.approx(lr.intercept, abs=2e-3)


def shard_of(ids, S):
    """The shard rule, recomputed in numpy."""
    M = 2147483647
    return (((ids % M) * 1327217885 + 3) % M) % S


def _local_rows(spark):
    pdf = hinge_rows(spark, SF_SMALL).orderBy("id").toPandas()
    return pdf[HINGE_FEATURES].to_numpy(), pdf["y"].to_numpy(), pdf["id"].to_numpy()


def test_one_shard_equals_sequential_pass(spark):
    X, y, _ = _local_rows(spark)
    cfg = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, shards=1, max_iter=1, tol=0.0, order="id")
    res = train_sgd(hinge_rows(spark, SF_SMALL), "id", HINGE_FEATURES, "y", cfg)
    st = ShardState(np.zeros((1, 2)), np.zeros(1))
    fold_hinge(st, X, y, 0.01, 1.0, True)
    np.testing.assert_allclose(res.model.coef, st.coef, rtol=1e-12, atol=1e-15)
    np.testing.assert_allclose(res.model.intercept, st.intercept, rtol=1e-12, atol=1e-15)


def test_shards_average_unweighted_with_empty_shards(spark):
    X, y, ids = _local_rows(spark)
    S = 400  # more shards than rows: many are empty and contribute the incoming model
    init = LinearModel([[0.3, -0.2]], [0.05])
    cfg = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, shards=S, max_iter=1, tol=0.0, order="id")
    res = train_sgd(hinge_rows(spark, SF_SMALL), "id", HINGE_FEATURES, "y", cfg, init=init)
    total_w, total_b = np.zeros(2), 0.0
    for s in range(S):
        sel = shard_of(ids, S) == s
        st = ShardState(init.coef, init.intercept)
        fold_hinge(st, X[sel], y[sel], 0.01, 1.0, True)
        total_w += st.coef[0]
        total_b += st.intercept[0]
    np.testing.assert_allclose(res.model.coef[0], total_w / S, rtol=1e-10, atol=1e-14)
    assert res.model.intercept[0] == pytest.approx(total_b / S, abs=1e-13)


def test_zero_step_sgd_stops_after_first_pass(spark):
    cfg = SGDConfig(kind="hinge", alpha=0.0, l2=1.0, shards=4, max_iter=5, tol=1e-9)
    init = LinearModel([[0.1, 0.2]], [0.3])
    res = train_sgd(hinge_rows(spark, SF_SMALL), "id", HINGE_FEATURES, "y", cfg, init=init)
    assert len(res.history) == 1 and res.history[0][4] is True
    np.testing.assert_array_equal(res.model.flat(), init.flat())


@pytest.mark.parametrize("mode", ["checkpoint", "none"])
def test_materialize_modes_agree(spark, mode):
    rows = hinge_rows(spark, SF_SMALL)
    base = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, shards=3, max_iter=2, tol=0.0)
    other = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, shards=3, max_iter=2, tol=0.0, materialize=mode)
    a = train_sgd(rows, "id", HINGE_FEATURES, "y", base)
    b = train_sgd(rows, "id", HINGE_FEATURES, "y", other)
    np.testing.assert_allclose(a.model.flat(), b.model.flat(), rtol=1e-12, atol=1e-15)
    g1 = train_gd(log_rows(spark, SF_SMALL), LIN_FEATURES, "y", GDConfig(loss="logistic", lr=0.5, max_epochs=4))
    g2 = train_gd(log_rows(spark, SF_SMALL), LIN_FEATURES, "y",
                  GDConfig(loss="logistic", lr=0.5, max_epochs=4, materialize=mode))
    np.testing.assert_allclose(g1.model.vector(), g2.model.vector(), rtol=1e-10, atol=1e-13)


@pytest.mark.parametrize("loss,rows_fn", [("logistic", log_rows), ("squared", lin_rows)])
def test_arrow_gradient_path_equals_literal_path(spark, loss, rows_fn):
    rows = rows_fn(spark, SF_SMALL)
    kw = dict(loss=loss, lr=0.2, tol=1e-4, max_epochs=12)
    a = train_gd(rows, LIN_FEATURES, "y", GDConfig(method="direct", **kw))
    b = train_gd(rows, LIN_FEATURES, "y", GDConfig(method="arrow", **kw))
    assert [h[4] for h in a.history] == [h[4] for h in b.history]
    np.testing.assert_allclose(a.model.vector(), b.model.vector(), rtol=1e-10, atol=1e-12)
    c = train_gd(rows.select(F.array(*LIN_FEATURES).alias("f"), "y"), "f", "y", GDConfig(**kw), n_features=3)
    np.testing.assert_allclose(a.model.vector(), c.model.vector(), rtol=1e-10, atol=1e-12)


def test_shard_count_grows_with_rows_and_matches_explicit_count(spark):
    rows = hinge_rows(spark, SF_SMALL)  # 150 rows
    capped = SGDConfig(kind="hinge", max_iter=2, tol=0.0, rows_per_shard=20)
    explicit = SGDConfig(kind="hinge", shards=8, max_iter=2, tol=0.0)
    a = train_sgd(rows, "id", HINGE_FEATURES, "y", capped)
    b = train_sgd(rows, "id", HINGE_FEATURES, "y", explicit)
    assert a.shards == 8 and b.shards == 8
    np.testing.assert_array_equal(a.model.flat(), b.model.flat())


@pytest.mark.parametrize("method", ["gram", "direct", "arrow"])
def test_null_features_raise_in_gd(spark, method):
    rows = lin_rows(spark, SF_SMALL).withColumn(
        "x2", F.when(F.col("l_linenumber") == 3, F.lit(None).cast("double")).otherwise(F.col("x2")))
    with pytest.raises(Exception, match="NULL"):
        train_gd(rows, LIN_FEATURES, "y", GDConfig(lr=0.1, tol=1e-3, method=method))


def test_null_features_raise_in_sgd(spark):
    rows = hinge_rows(spark, SF_SMALL).withColumn(
        "x1", F.when(F.col("id") == 7, F.lit(None).cast("double")).otherwise(F.col("x1")))
    with pytest.raises(Exception, match="NULL"):
        train_sgd(rows, "id", HINGE_FEATURES, "y", SGDConfig(kind="hinge", max_iter=1))


def test_shards_sharing_partitions_give_the_same_model(spark):
    rows = hinge_rows(spark, SF_SMALL)
    one = SGDConfig(kind="hinge", shards=12, max_iter=2, tol=0.0)
    shared = SGDConfig(kind="hinge", shards=12, max_iter=2, tol=0.0, max_partitions=5)
    a = train_sgd(rows, "id", HINGE_FEATURES, "y", one)
    b = train_sgd(rows, "id", HINGE_FEATURES, "y", shared)
    np.testing.assert_allclose(a.model.flat(), b.model.flat(), rtol=1e-12, atol=1e-15)
    assert [h[1] for h in a.history] == [h[1] for h in b.history]


def test_logistic_optimum_of_pyspark_ml_is_stationary_for_our_gradient(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from ridgeway.operators.gradient import gradient_stats
    rows = log_rows(spark, SF_SMALL)
    va = VectorAssembler(inputCols=LIN_FEATURES, outputCol="f")
    ml = LogisticRegression(featuresCol="f", labelCol="y", regParam=0.0, standardization=False,
                            maxIter=200, tol=1e-12).fit(va.transform(rows))
    w = [ml.intercept, *ml.coefficients.toArray()]
    r = gradient_stats(rows, LIN_FEATURES, "y", w, "logistic").collect()[0]
    n = r["n_rows"]
    assert max(abs(r[f"g{i}"]) / n for i in range(4)) < 1e-6
    gd = train_gd(rows, LIN_FEATURES, "y", GDConfig(loss="logistic", lr=0.15, tol=1e-4))
    assert r["loss_sum"] / n <= gd.history[-1][2] + 1e-12


def test_hash_order_epochs_match_numpy_replay(spark):
    X, y, ids = _local_rows(spark)
    S, alpha, l2, epochs = 3, 0.01, 1.0, 2
    cfg = SGDConfig(kind="hinge", alpha=alpha, l2=l2, shards=S, max_iter=epochs, tol=0.0, order="hash")
    res = train_sgd(hinge_rows(spark, SF_SMALL), "id", HINGE_FEATURES, "y", cfg, keep_models=True)
    model = LinearModel.zeros(1, 2)
    for e in range(1, epochs + 1):
        key = ids % 2147483647 * pow(48271, e, 2147483647) % 2147483647
        total_w, total_b = np.zeros(2), 0.0
        for s in range(S):
            sel = np.flatnonzero(shard_of(ids, S) == s)
            sel = sel[np.lexsort((ids[sel], key[sel]))]
            st = ShardState(model.coef, model.intercept)
            fold_hinge(st, X[sel], y[sel], alpha, l2, True)
            total_w += st.coef[0]
            total_b += st.intercept[0]
        model = LinearModel([total_w / S], [total_b / S])
        np.testing.assert_allclose(res.models[e - 1].flat(), model.flat(), rtol=1e-11, atol=1e-14)


def test_gd_and_sgd_resume_from_a_training_log(spark):
    from ridgeway.session import scratch_path
    from ridgeway.sources.training_log import TrainingLog
    rows = log_rows(spark, SF_SMALL)
    full = train_gd(rows, LIN_FEATURES, "y", GDConfig(loss="logistic", lr=0.5, tol=1e-4, max_epochs=9))
    log = TrainingLog(spark, scratch_path(spark, "gd-log"))
    train_gd(rows, LIN_FEATURES, "y", GDConfig(loss="logistic", lr=0.5, tol=1e-4, max_epochs=4), log=log)
    resumed = train_gd(rows, LIN_FEATURES, "y", GDConfig(loss="logistic", lr=0.5, tol=1e-4, max_epochs=9), log=log)
    np.testing.assert_allclose(resumed.model.vector(), full.model.vector(), rtol=1e-12, atol=1e-15)
    assert [h[0] for h in resumed.history] == [h[0] for h in full.history]
    again = train_gd(rows, LIN_FEATURES, "y", GDConfig(loss="logistic", lr=0.5, tol=1e-4, max_epochs=9), log=log)
    np.testing.assert_array_equal(again.model.vector(), resumed.model.vector())

    hr = hinge_rows(spark, SF_SMALL)
    sfull = train_sgd(hr, "id", HINGE_FEATURES, "y", SGDConfig(kind="hinge", max_iter=4, tol=0.0))
    slog = TrainingLog(spark, scratch_path(spark, "sgd-log"))
    train_sgd(hr, "id", HINGE_FEATURES, "y", SGDConfig(kind="hinge", max_iter=2, tol=0.0), log=slog)
    sres = train_sgd(hr, "id", HINGE_FEATURES, "y", SGDConfig(kind="hinge", max_iter=4, tol=0.0), log=slog)
    np.testing.assert_allclose(sres.model.flat(), sfull.model.flat(), rtol=1e-12, atol=1e-15)
    assert len(sres.history) == 4


@pytest.mark.parametrize("method", ["gram", "direct"])
def test_gd_on_empty_input_stops_at_the_start(spark, method):
    rows = lin_rows(spark, SF_SMALL).filter(F.col("y") < F.lit(-1.0))
    res = train_gd(rows, LIN_FEATURES, "y", GDConfig(lr=0.1, method=method), init=[0.1, 0.2, 0.3, 0.4])
    assert len(res.history) == 1 and res.history[0][4] is True and res.history[0][1] == 0
    np.testing.assert_array_equal(res.model.vector(), [0.1, 0.2, 0.3, 0.4])


def test_sgd_on_empty_input_keeps_the_model(spark):
    rows = hinge_rows(spark, SF_SMALL).filter(F.col("id") < F.lit(0))
    init = LinearModel([[0.5, -0.5]], [0.25])
    res = train_sgd(rows, "id", HINGE_FEATURES, "y", SGDConfig(kind="hinge", max_iter=3), init=init)
    assert res.history[0][1] == 0 and res.history[0][4] is True
    np.testing.assert_array_equal(res.model.flat(), init.flat())


def test_grouped_identical_rows_give_the_same_gd(spark):
    rows = log_rows(spark, SF_SMALL)
    kw = dict(loss="logistic", lr=0.3, tol=1e-5, max_epochs=25, method="direct")
    a = train_gd(rows, LIN_FEATURES, "y", GDConfig(compress="never", **kw))
    b = train_gd(rows, LIN_FEATURES, "y", GDConfig(compress="always", **kw))
    assert [h[1] for h in a.history] == [h[1] for h in b.history]
    assert [h[4] for h in a.history] == [h[4] for h in b.history]
    np.testing.assert_allclose(a.model.vector(), b.model.vector(), rtol=1e-10, atol=1e-13)


def test_aggregated_and_direct_epoch_sums_agree(spark, monkeypatch):
    from ridgeway.operators import array_sum
    rows = hinge_rows(spark, SF_SMALL)
    cfg = SGDConfig(kind="hinge", shards=6, max_iter=2, tol=0.0)
    direct = train_sgd(rows, "id", HINGE_FEATURES, "y", cfg)
    monkeypatch.setattr(array_sum, "DIRECT_VALUES", 0)
    aggregated = train_sgd(rows, "id", HINGE_FEATURES, "y", cfg)
    np.testing.assert_allclose(direct.model.flat(), aggregated.model.flat(), rtol=1e-12, atol=1e-15)
    assert [h[1] for h in direct.history] == [h[1] for h in aggregated.history]


def test_resume_after_a_crash_between_model_and_history(spark):
    from ridgeway.session import scratch_path
    from ridgeway.sources.training_log import TrainingLog
    rows = log_rows(spark, SF_SMALL)
    cfg = GDConfig(loss="logistic", lr=0.5, tol=1e-4, max_epochs=5)
    full = train_gd(rows, LIN_FEATURES, "y", cfg, keep_models=True)
    log = TrainingLog(spark, scratch_path(spark, "crash-log"))
    train_gd(rows, LIN_FEATURES, "y", GDConfig(loss="logistic", lr=0.5, tol=1e-4, max_epochs=2), log=log)
    log.models.write(full.models[2].to_table(spark), 3)        # epoch 3's model, no history row
    res = train_gd(rows, LIN_FEATURES, "y", cfg, log=log)
    np.testing.assert_allclose(res.model.vector(), full.model.vector(), rtol=1e-12, atol=1e-15)
    assert log.models.read_epoch(3).count() == 4


def test_strided_ids_still_fill_every_shard(spark):
    from ridgeway.operators.sgd import prepare_shards
    rows = hinge_rows(spark, SF_SMALL).withColumn("id", F.col("id") * F.lit(8))  # all ids = 0 mod 8
    counts = {r["shard"]: r["count"] for r in
              prepare_shards(rows, "id", HINGE_FEATURES, "y", 8).groupBy("shard").count().collect()}
    assert len(counts) == 8 and max(counts.values()) < 3 * 150 / 8


def test_grouped_rows_with_checkpoint_materialisation(spark):
    rows = log_rows(spark, SF_SMALL)
    kw = dict(loss="logistic", lr=0.3, tol=1e-5, max_epochs=10, method="direct")
    a = train_gd(rows, LIN_FEATURES, "y", GDConfig(compress="never", **kw))
    b = train_gd(rows, LIN_FEATURES, "y", GDConfig(compress="always", materialize="checkpoint", **kw))
    np.testing.assert_allclose(a.model.vector(), b.model.vector(), rtol=1e-10, atol=1e-13)


@pytest.mark.parametrize("lr, tol", [(1e-5, 1e-5), (1e-3, 1e-7), (0.3, 1e-9), (0.3, 10.0), (0.9, 0.0)])
def test_bisected_stopping_epoch_equals_the_epoch_loop(spark, lr, tol):
    from ridgeway.operators.gd import gram_loss, stopping_epoch
    from ridgeway.operators.gradient import gram_stats
    stats = gram_stats(lin_rows(spark, SF_SMALL), LIN_FEATURES, "y")
    cfg = GDConfig(lr=lr, tol=tol, max_epochs=None)
    start = np.array([0.3, -0.2, 0.1, 0.0])
    found = stopping_epoch(stats, start, cfg)
    if 2 * lr * np.linalg.eigvalsh(stats["G"] / stats["n"])[-1] > 2:
        assert found is None       # the loss may grow: epochs are run one by one
        return
    w, prev, epoch, last = start, np.inf, 0, start
    while tol and epoch < 200_000:
        epoch, loss = epoch + 1, gram_loss(stats, w)
        if not prev - loss > tol:
            break
        w, prev, last = w - 2 * lr * (stats["G"] @ w - stats["h"]) / stats["n"], loss, w
    if tol:
        assert found[0] == epoch
        np.testing.assert_allclose(found[1], w, rtol=1e-9, atol=1e-12)
        np.testing.assert_allclose(found[2], last, rtol=1e-9, atol=1e-12)


def test_a_run_without_epoch_limit_ends_by_its_stop_test(spark):
    rows = lin_rows(spark, SF_SMALL)
    free = train_gd(rows, LIN_FEATURES, "y", GDConfig(lr=1e-2, tol=1e-6, max_epochs=None))
    looped = train_gd(rows, LIN_FEATURES, "y", GDConfig(lr=1e-2, tol=1e-6, max_epochs=100_000))
    assert free.converged and looped.converged and [h[0] for h in free.history] == [len(looped.history) - 1, len(looped.history)]
    for a, b in zip(free.history, looped.history[-2:]):
        assert a == pytest.approx(b, rel=1e-9, abs=1e-12)
    np.testing.assert_allclose(free.model.vector(), looped.model.vector(), rtol=1e-9)
    ridge = dict(lr=1e-2, l2=1e-3, tol=1e-6)   # an L2 term: epoch by epoch, with the whole history
    a = train_gd(rows, LIN_FEATURES, "y", GDConfig(**ridge, max_epochs=None))
    b = train_gd(rows, LIN_FEATURES, "y", GDConfig(**ridge, max_epochs=100_000))
    assert a.converged and len(a.history) == len(b.history)
    empty = train_gd(rows.limit(0), LIN_FEATURES, "y", GDConfig(lr=0.1, max_epochs=None))
    assert len(empty.history) == 1 and empty.converged
    with pytest.raises(ValueError, match="epoch limit"):
        GDConfig(loss="logistic", max_epochs=None)


def test_arrow_gram_equals_generated_sums(spark, monkeypatch):
    from ridgeway.operators import array_sum, gradient
    rows = lin_rows(spark, SF_SMALL).repartition(5)
    want = gradient.gram_stats(rows, LIN_FEATURES, "y")
    arrays = rows.select(F.array(*LIN_FEATURES).alias("f"), "y")
    for direct, chunk in ((10 ** 6, 4096), (0, 4096), (0, 4)):   # added on the driver, in two levels, in several chunks
        monkeypatch.setattr(array_sum, "DIRECT_VALUES", direct)
        monkeypatch.setattr(array_sum, "CHUNK", chunk)
        got = gradient.gram_stats(arrays, "f", "y", 3)
        assert got["n"] == want["n"]
        for key in ("q", "h", "G"):
            np.testing.assert_allclose(got[key], want[key], rtol=1e-11)
    with pytest.raises(Exception, match="length 3"):
        gradient.gram_stats(rows.select(F.array("x1").alias("f"), "y"), "f", "y", 3)


def test_labels_are_checked_on_every_path(spark):
    from ridgeway.operators.sgd import sgd_pass
    from ridgeway.estimators import MLR, SVM
    base = [(i, [float(i % 3), 1.0], i % 3) for i in range(12)]
    for bad, words in ((-1.0, "0..K-1"), (1.7, "whole"), (3.0, "0..K-1")):
        rows = spark.createDataFrame([(i, f, bad if i == 7 else float(y)) for i, f, y in base], "id long, features array<double>, label double")
        for cfg in (SGDConfig(kind="softmax", shards=2), SGDConfig(kind="multiclass_hinge", rows_per_shard=3)):
            with pytest.raises(Exception, match=words):
                sgd_pass(rows, "id", "features", "label", cfg, LinearModel.zeros(3, 2))
        fitted = MLR(alpha=0.1, max_iter=1, shards=2)
        fitted.model = LinearModel.zeros(3, 2)
        with pytest.raises(Exception, match=words):
            fitted.partial_fit(rows)
    rows = spark.createDataFrame([(1, 0.5, 0.5, 1.0), (2, 0.1, 0.2, 0.0)], "id long, x1 double, x2 double, y double")
    with pytest.raises(Exception, match="-1 or 1"):
        sgd_pass(rows, "id", ["x1", "x2"], "y", SGDConfig(shards=2), LinearModel.zeros(1, 2))
    svm = SVM(n_epochs=1, shards=2)
    svm.model = LinearModel.zeros(1, 2)
    with pytest.raises(Exception, match="-1 or 1"):
        svm.partial_fit(rows)


def test_resharded_passes_match_numpy_replay(spark):
    """Rows dealt anew each pass: shard and order follow the epoch; every materialisation, one block or many."""
    X, y, ids = _local_rows(spark)
    S, M, epochs = 5, 2147483647, 3
    cfg = SGDConfig(kind="hinge", alpha=0.01, l2=0.1, shards=S, max_iter=epochs, tol=0.0, reshard=True)
    model, seen = LinearModel.zeros(1, 2), []
    for e in range(1, epochs + 1):
        shard = ((ids % M) * (1327217885 * pow(69621, e, M) % M) + 3) % M % S
        key = ids % M * pow(48271, e, M) % M
        seen.append(shard)
        w, b = np.zeros((1, 2)), np.zeros(1)
        for s in range(S):
            sel = np.flatnonzero(shard == s)
            sel = sel[np.lexsort((ids[sel], key[sel]))]
            st = ShardState(model.coef, model.intercept)
            fold_hinge(st, X[sel], y[sel], 0.01, 0.1, True)
            w, b = w + st.coef, b + st.intercept
        model = LinearModel(w / S, b / S)
    assert (seen[0] != seen[1]).mean() > 0.5    # most rows change their shard
    for how in ("persist", "checkpoint", "none"):
        got = train_sgd(hinge_rows(spark, SF_SMALL), "id", HINGE_FEATURES, "y", SGDConfig(**{**cfg.__dict__, "materialize": how}))
        np.testing.assert_allclose(got.model.flat(), model.flat(), rtol=1e-11, atol=1e-14)


@pytest.mark.parametrize("order", ["hash", "id"])
def test_blocks_and_streamed_rows_give_one_model(spark, monkeypatch, order):
    from ridgeway.operators import array_sum, sgd as sgd_mod
    rows = hinge_rows(spark, SF_SMALL)
    cfg = SGDConfig(kind="hinge", shards=6, max_iter=3, tol=0.0, order=order)
    want = train_sgd(rows, "id", HINGE_FEATURES, "y", cfg)
    small = train_sgd(rows, "id", HINGE_FEATURES, "y", SGDConfig(**{**cfg.__dict__, "materialize": "checkpoint"}))
    np.testing.assert_allclose(small.model.flat(), want.model.flat(), rtol=1e-12, atol=1e-15)
    monkeypatch.setattr(array_sum, "DIRECT_VALUES", 0)         # sums in a tree
    tree = train_sgd(rows, "id", HINGE_FEATURES, "y", cfg)
    monkeypatch.setattr(sgd_mod, "LOCKSTEP_BYTES", 64)         # shards larger than a block: sorted and streamed
    streamed = train_sgd(rows, "id", HINGE_FEATURES, "y", cfg)
    for got in (tree, streamed):
        np.testing.assert_allclose(got.model.flat(), want.model.flat(), rtol=1e-12, atol=1e-15)
        assert [h[:2] for h in got.history] == [h[:2] for h in want.history]


@pytest.mark.parametrize("mode", ["persist", "none"])
def test_first_epoch_decides_the_grouping(spark, monkeypatch, mode):
    from ridgeway.operators import gd as GD
    from ridgeway.operators import gradient as GR
    calls = []
    monkeypatch.setattr(GD, "gradient_of_blocks", lambda *a: calls.append(1) or GR.gradient_of_blocks(*a))
    monkeypatch.setattr(GR, "BLOCK_BYTES", 64)
    few = spark.range(300).selectExpr("double(id % 5) / 5 AS a", "double(id % 3) AS b", "double(id % 5 > 2) AS y").repartition(3)
    many = spark.range(300).selectExpr("double(id) / 300 AS a", "double(id % 3) AS b", "double(id % 5 > 2) AS y")
    kw = dict(loss="logistic", lr=0.3, tol=-1.0, max_epochs=5, materialize=mode)
    for rows, grouped in ((few, 4), (many, 0)):
        calls.clear()
        a = train_gd(rows, ["a", "b"], "y", GDConfig(**kw))
        assert len(calls) == grouped
        b = train_gd(rows, ["a", "b"], "y", GDConfig(compress="never", **kw))
        assert np.allclose(a.model.vector(), b.model.vector(), atol=1e-12)
        assert np.allclose([h[2] for h in a.history], [h[2] for h in b.history], atol=1e-12)
    with pytest.raises(Exception, match="NULL or NaN"):
        train_gd(few.withColumn("a", F.expr("if(b = 1, null, a)")), ["a", "b"], "y", GDConfig(compress="always", **kw))
