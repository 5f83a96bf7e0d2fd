"""One rule at every size: shards, samples, checks and text formats do not change with the input."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeway.model import LinearModel
from ridgeway.operators.gd import GDConfig, train_gd
from ridgeway.operators.gradient import compress_rows, gradient_stats_arrow
from ridgeway.operators.sample import first_n_by
from ridgeway.operators.scoring import with_class_scores
from ridgeway.operators.sgd import SGDConfig, order_key, resolve_shards, train_sgd
from ridgeway.session import checkpoint_dir, scratch_path
from ridgeway.sources.blobs import blob_table
from ridgeway.sources.model_io import write_model
from ridgeway.sources.text import read_labelled_text


def test_shard_rule_has_no_threshold():
    exact = SGDConfig(shards=1)
    assert {resolve_shards(n, exact) for n in (0, 10, 10**6, 10**7, 10**12)} == {1}
    sized = SGDConfig(rows_per_shard=1000)
    assert [resolve_shards(n, sized) for n in (0, 1, 1000, 1001, 10**9)] == [1, 1, 1, 2, 10**6]
    with pytest.raises(ValueError, match="not both"):
        SGDConfig(shards=2, rows_per_shard=10)


def test_epoch_orders_are_not_rotations_and_large_ids_do_not_overflow(spark):
    ids = spark.range(1, 200)
    orders = [[r.id for r in ids.orderBy(order_key(F.col("id"), e), "id").collect()] for e in (1, 2, 3)]
    for a, b in zip(orders, orders[1:]):
        at = b.index(a[0])
        assert b[at:] + b[:at] != a
    big = spark.range(1).select((F.lit(2**62) + F.col("id")).alias("id"))
    assert big.select(order_key(F.col("id"), 7).alias("k")).first()["k"] == 2**62 % 2147483647 * pow(48271, 7, 2147483647) % 2147483647
    assert blob_table(big, "id").count() == 1 and blob_table(big, "id").first()["x1"] is not None


@pytest.mark.parametrize("direct", [0, 100_000])
@pytest.mark.parametrize("n", [2, 5, 60, 300])
def test_first_n_leaves_null_keys_out_at_every_size(spark, monkeypatch, n, direct):
    monkeypatch.setattr("ridgeway.operators.sample.DIRECT_ROWS", direct)
    rows = spark.range(200).select(F.when(F.col("id") % 67 != 0, F.col("id")).alias("k"))
    got = [r.k for r in first_n_by(rows, "k", n, buckets=4, slack=1.0).collect()]
    assert got == [k for k in range(200) if k % 67][:n]


@pytest.mark.parametrize("direct", [0, 100_000])
def test_first_n_with_one_hot_key_and_wide_range(spark, monkeypatch, direct):
    monkeypatch.setattr("ridgeway.operators.sample.DIRECT_ROWS", direct)
    rows = spark.range(300).select(F.when(F.col("id") < 250, F.lit(-2**62)).otherwise(F.col("id") * 2**53).alias("k"))
    assert [r.k for r in first_n_by(rows, "k", 252, slack=1.0).collect()][-2:] == [250 * 2**53, 251 * 2**53]
    assert first_n_by(rows.limit(0), "k", 3).count() == 0


@pytest.mark.parametrize("fmt", ["lines", "record"])
def test_text_sinks_refuse_several_classes(spark, fmt):
    model = LinearModel(np.ones((3, 2)), np.zeros(3)).to_table(spark)
    with pytest.raises(ValueError, match="single-output"):
        write_model(model, scratch_path(spark, "k-class"), fmt)


@pytest.mark.parametrize("line", ["1.0\t\t2.0", "", "1.0\tabc\t2.0", "1.0\t2.0", "1\t2\t3\t4"])
def test_labelled_text_checks_every_field_of_every_line(spark, line):
    path = scratch_path(spark, "bad-line")
    spark.createDataFrame([("1.0\t2.0\t3.0",), (line,)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception, match="malformed labelled line"):
        read_labelled_text(spark, path, 2).select("y").collect()


def _rows(spark, data):
    return spark.createDataFrame(data, "id long, features array<double>, label double")


@pytest.mark.parametrize("bad", [[1.0, 2.0], [1.0, 2.0, 3.0, 4.0], None, [1.0, None, 3.0], [1.0, float("nan"), 3.0]])
def test_every_path_refuses_bad_feature_rows(spark, bad):
    # two rows of lengths 2 and 4 would pass a check of the total length alone
    rows = _rows(spark, [(1, bad, 1.0), (2, [1.0, 2.0, 3.0, 4.0] if bad and len(bad) == 2 else [1.0, 2.0, 3.0], 0.0)]).coalesce(1)
    start = LinearModel(np.ones((2, 3)), np.zeros(2))
    calls = [lambda: gradient_stats_arrow(rows, "features", "label", [0.0] * 4, "logistic"),
             lambda: train_sgd(rows, "id", "features", "label", SGDConfig(kind="softmax", shards=1, max_iter=1), init=start),
             lambda: with_class_scores(rows, "features", start, method="arrow").collect(),
             lambda: with_class_scores(rows, "features", start, method="expression").collect()]
    for call in calls:
        with pytest.raises(Exception, match="feature rows must all have length 3|NULL or NaN"):
            call()


@pytest.mark.parametrize("kind,labels", [("softmax", [-1.0, 0.0, 1.0]), ("softmax", [0.0, 0.5, 1.0]), ("hinge", [0.0, 1.0, 1.0]),
                                         ("multiclass_hinge", [0.0, 1.0, None]), ("softmax", [0.0, 1.0, 5.0])])
def test_labels_are_checked_with_and_without_a_start_model(spark, kind, labels):
    rows = _rows(spark, [(i, [1.0, 2.0], y) for i, y in enumerate(labels)])
    start = LinearModel.zeros(1 if kind == "hinge" else 3, 2)
    for init in (None, start):
        with pytest.raises(ValueError, match="labels|NULL"):
            train_sgd(rows, "id", "features", "label", SGDConfig(kind=kind, shards=1, max_iter=1), init=init)


@pytest.mark.parametrize("method", ["gram", "direct", "arrow"])
def test_nan_features_raise_in_gd(spark, method):
    rows = spark.createDataFrame([(1.0, 2.0, 1.0), (float("nan"), 1.0, 0.0)], "x1 double, x2 double, y double")
    with pytest.raises(Exception, match="NaN"):
        train_gd(rows, ["x1", "x2"], "y", GDConfig(method=method))


def test_grouping_runs_in_many_tasks_before_it_moves_to_one(spark):
    rows = spark.range(1000).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    grouped = compress_rows(rows, ["x"], "y", 0.5)
    plan = grouped._jdf.queryExecution().toString()
    assert "Repartition 1" in plan and "Coalesce" not in plan
    assert grouped.count() == 14 and grouped.rdd.getNumPartitions() == 1


def test_runs_say_whether_they_converged(spark):
    rows = spark.createDataFrame([(float(i), float(2 * i)) for i in range(5)], "x double, y double")
    with pytest.warns(UserWarning, match="max_epochs"):
        short = train_gd(rows, ["x"], "y", GDConfig(lr=0.01, tol=1e-9, max_epochs=2))
    assert not short.converged and short.models == []
    assert train_gd(rows, ["x"], "y", GDConfig(lr=0.01, tol=1e-2, max_epochs=500)).converged


def test_scratch_folder_is_only_invented_for_a_local_master():
    class Conf:
        get = staticmethod(lambda *a: None)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: Conf)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)
