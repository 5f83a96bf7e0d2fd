"""The estimator surface (fit / partial_fit / predict) over the Spark operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ridgeway.estimators import MLR, SVM, LinearRegressionGD, LogisticRegressionGD, MultiSVM
from ridgeway.operators.folds import ShardState, fold_hinge
from ridgeway.sources.tables import LIN_FEATURES, class_rows, hinge_rows, lin_rows, log_rows
from tests.conftest import SF_SMALL


def test_svm_partial_fit_is_sequential_and_scores(spark):
    rows = hinge_rows(spark, SF_SMALL)
    pdf = rows.orderBy("id").toPandas()
    X, y = pdf[["x1", "x2"]].to_numpy(), pdf["y"].to_numpy()
    svm = SVM(alpha=0.01, l=1.0).partial_fit(rows).partial_fit(rows)
    st = ShardState(np.zeros((1, 2)), np.zeros(1))
    fold_hinge(st, X, y, 0.01, 1.0, True)
    fold_hinge(st, X, y, 0.01, 1.0, True)
    np.testing.assert_allclose(svm.model.coef, st.coef, rtol=1e-12, atol=1e-15)
    scored = svm.predict(rows).select("id", "score").orderBy("id").toPandas()
    np.testing.assert_allclose(scored["score"].to_numpy(), X @ st.coef[0] + st.intercept[0], atol=1e-12)
    lines = svm.support_vec(svm.hyperplane_coord(rows), 1.0).select("boundary", "margin_line").first()
    assert lines["boundary"] is not None and lines["margin_line"] is not None


def test_svm_fit_runs_all_epochs_on_one_shard(spark):
    svm = SVM(alpha=0.01, n_epochs=3).fit(hinge_rows(spark, SF_SMALL))
    assert len(svm.history) == 3


def test_multiclass_estimators_predict_valid_classes(spark):
    rows = class_rows(spark, SF_SMALL)
    for est in (MultiSVM(alpha=0.01, l=1e-4, max_iter=1, shards=4),
                MLR(alpha=0.05, max_iter=1, shards=4)):
        est.fit(rows)
        pred = est.predict(rows)
        assert pred.filter((F.col("prediction") < 0) | (F.col("prediction") > 9)).count() == 0
    probs = MLR(alpha=0.05, max_iter=1).fit(rows).predict_proba(rows)
    s = probs.select(F.aggregate("probs", F.lit(0.0), lambda a, v: a + v).alias("s")).toPandas()["s"]
    np.testing.assert_allclose(s.to_numpy(), 1.0, atol=1e-12)


def test_gd_estimators(spark):
    lin = LinearRegressionGD(LIN_FEATURES, lr=0.1, l2=0.001, tol=1e-3).fit(lin_rows(spark, SF_SMALL))
    assert lin.history[-1][4] is True
    log = LogisticRegressionGD(LIN_FEATURES, lr=0.2, tol=1e-4).fit(log_rows(spark, SF_SMALL))
    p = log.predict_proba(log_rows(spark, SF_SMALL)).agg(F.min("prob"), F.max("prob")).first()
    assert 0.0 < p[0] <= p[1] < 1.0


def test_estimator_fit_resumes_from_a_log(spark):
    from ridgeway.session import scratch_path
    from ridgeway.sources.training_log import TrainingLog
    rows = hinge_rows(spark, SF_SMALL)
    full = SVM(alpha=0.01, n_epochs=4, shards=3).fit(rows)
    log = TrainingLog(spark, scratch_path(spark, "svm-log"))
    SVM(alpha=0.01, n_epochs=2, shards=3).fit(rows, log=log)
    resumed = SVM(alpha=0.01, n_epochs=4, shards=3).fit(rows, log=log)
    np.testing.assert_allclose(resumed.model.flat(), full.model.flat(), rtol=1e-12, atol=1e-15)
