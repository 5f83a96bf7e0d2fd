"""Models by feature block: equal to the driver-held trainer, with the bound below the model's width."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ridgeway.model import LinearModel
from ridgeway.operators import blocked as B
from ridgeway.operators import gradient as G
from ridgeway.operators.gd import GDConfig, train_gd


def weights(model) -> np.ndarray:
    return np.array([r.weight for r in model.orderBy("feature_idx").collect()])


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(60, 10))
    X[:, 7:] *= rng.random((60, 3)) < 0.2      # some nearly empty features
    X[:, 9] = 0.0                              # and one without any value
    y = (X[:, 0] - X[:, 4] > 0).astype(float)
    return spark.createDataFrame([(int(i) * 3, x.tolist(), float(t)) for i, (x, t) in enumerate(zip(X, y))],
                                 "id long, features array<double>, y double").repartition(3).cache()


@pytest.mark.parametrize("loss, l2, block_size, parts", [("squared", 0.01, 4, 3), ("logistic", 0.0, 11, 1), ("squared", 0.0, 1, 2)])
def test_equals_the_trainer_on_the_driver(rows, monkeypatch, loss, l2, block_size, parts):
    cfg = GDConfig(loss=loss, lr=0.1, l2=l2, tol=1e-3, max_epochs=6)
    start = LinearModel.from_vector(np.linspace(-0.5, 0.5, 11))
    want = train_gd(rows, "features", "y", cfg, init=start, n_features=10)
    spark = rows.sparkSession
    init = start.to_table(spark)
    monkeypatch.setattr(G, "MAX_MODEL_CELLS", 4)
    with pytest.raises(ValueError):
        train_gd(rows, "features", "y", cfg, init=start, n_features=10)
    got = B.train_gd_blocked(B.cells_of_arrays(rows, "features", "y", "id", 10, block_size), 10, cfg, init,
                             block_size=block_size, parts=parts, tasks=3)
    assert np.allclose(weights(got.model), want.model.vector(), atol=1e-12, rtol=0)
    assert [h[0:2] + h[4:] for h in got.history] == [h[0:2] + h[4:] for h in want.history]
    assert np.allclose([h[2:4] for h in got.history], [h[2:4] for h in want.history], atol=1e-12)


def test_sparse_pairs_equal_dense_rows(rows):
    cfg = GDConfig(loss="logistic", lr=0.2, tol=1e-3, max_epochs=3)
    pairs = rows.select("id", F.posexplode("features").alias("p", "value")).where("value <> 0").selectExpr("id", "p + 1 AS feature_idx", "value")
    halves = pairs.selectExpr("id", "feature_idx", "value / 2 AS value")    # a cell that stands twice is one sum
    sparse = B.cells_of_pairs(rows, halves.unionAll(halves), "y", "id", 10, 4)
    dense = B.cells_of_arrays(rows, "features", "y", "id", 10, 4)
    a, b = (B.train_gd_blocked(c, 10, cfg, block_size=4, tasks=2) for c in (sparse, dense))
    assert np.allclose(weights(a.model), weights(b.model), atol=1e-12) and a.model.count() == 11
    with pytest.raises(PySparkException):
        B.cells_of_pairs(rows, pairs.selectExpr("id", "feature_idx + 1 AS feature_idx", "value").unionAll(pairs.selectExpr("id", "0", "value")),
                         "y", "id", 10, 4).collect()


def test_scores_and_plan(rows):
    model = LinearModel.from_vector(np.arange(11) / 10.0).to_table(rows.sparkSession)
    got = {r.id: r.z for r in B.score(rows, "features", "id", model, 10, block_size=3, parts=2).collect()}
    for r in rows.collect():
        assert abs(got[r.id] - float(np.dot(r.features, np.arange(1, 11) / 10.0))) < 1e-12
    with pytest.raises(PySparkException):
        B.score(rows, "features", "id", model.where("feature_idx < 10"), 10, block_size=3).collect()


def test_refusals(rows):
    spark, cfg = rows.sparkSession, GDConfig(max_epochs=2)
    cells = lambda r: B.cells_of_arrays(r, "features", "y", "id", 10, 4)
    for broken in (rows.withColumn("y", F.lit(float("nan"))), rows.withColumn("id", F.lit(1)),
                   rows.withColumn("features", F.transform("features", lambda x: F.lit(None).cast("double")))):
        with pytest.raises(ValueError):
            B.train_gd_blocked(cells(broken), 10, cfg, block_size=4, tasks=2)
    with pytest.raises(ValueError):
        B.train_gd_blocked(cells(rows), 10, cfg, B.zero_model(spark, 9), block_size=4, tasks=2)
    with pytest.raises(PySparkException):
        B.cells_of_arrays(rows, "features", "y", "id", 9, 4).collect()
    empty = B.train_gd_blocked(cells(rows.limit(0)), 10, cfg, block_size=4, tasks=2)
    assert empty.converged and empty.history[0][1] == 0 and not weights(empty.model).any()


def test_no_epoch_moves_the_cells(rows):
    """Beyond the size Spark broadcasts, the cells keep the partitioning they were dealt by."""
    spark = rows.sparkSession
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = B.cells_of_arrays(rows, "features", "y", "id", 10, 4).withColumn("part", B._part("row", 3)).repartition(4, "block", "part").persist()
        cells.count()
        z = B.predictor(cells, B.zero_model(spark, 10), 4, 3)
        plan = z._jdf.queryExecution().executedPlan().toString()
        # the row sums and the model's two exchanges (by block, by block and part)
        assert "SortMergeJoin" in plan and plan.split("InMemoryRelation")[0].count("Exchange hashpartitioning(block") == 0
        assert sum(r.z for r in z.collect()) == 0.0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        cells.unpersist()
