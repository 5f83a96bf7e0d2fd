"""Text scans fail fast; scoring edge cases; model store; streaming replay."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeway.functions.linear import logistic_nll
from ridgeway.functions.multiclass import argmax, softmax
from ridgeway.model import LinearModel
from ridgeway.operators.scoring import boundary_lines, ranked_classes, with_class_scores
from ridgeway.operators.sgd import SGDConfig, prepare_shards, run_epoch
from ridgeway.session import scratch_path
from ridgeway.sources.model_store import ModelStore
from ridgeway.sources.tables import HINGE_FEATURES, class_rows, stream_rows
from ridgeway.sources.text import read_tsv_rows, read_weight_record, write_weight_record
from ridgeway.streaming.online import OnlineUpdate, chunk_column
from tests.conftest import SF_SMALL


def _write_lines(spark, lines):
    path = scratch_path(spark, "bad-text")
    spark.createDataFrame([(s,) for s in lines], "value string").coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("lines", [["1.0\t2.0\t3.0", "1.0\t2.0"], ["1.0\tabc\t3.0"]])
def test_malformed_text_fails(spark, lines):
    path = _write_lines(spark, lines)
    with pytest.raises(Exception):
        read_tsv_rows(spark, path, 2).collect()


def test_weight_record_round_trip(spark):
    m = LinearModel.from_vector([0.1, -2.5e-7, 3.0, 1e10])
    path = scratch_path(spark, "rec")
    write_weight_record(m.to_table(spark), path)
    line = spark.read.text(path).first()[0]
    assert line.startswith("weights,")
    back = LinearModel.from_table(read_weight_record(spark, path))
    np.testing.assert_array_equal(back.vector(), m.vector())


def test_argmax_ties_go_to_lowest_index_and_softmax_sums_to_one(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([900.0, -900.0, 0.0],)], "s array<double>")
    r = df.select(argmax("s").alias("a"), softmax("s").alias("p")).collect()
    assert [x["a"] for x in r] == [1, 0]
    for x in r:
        assert sum(x["p"]) == pytest.approx(1.0)
    rk = ranked_classes(df.withColumn("id", F.monotonically_increasing_id()), "id", "s")
    firsts = rk.filter("class_rank = 1").orderBy("id").select("class_idx").collect()
    assert [x[0] for x in firsts] == [1, 0]


def test_stable_nll_is_finite_when_saturated(spark):
    df = spark.createDataFrame([(1000.0, 0.0), (-1000.0, 1.0), (1000.0, 1.0)], "z double, y double")
    vals = [r[0] for r in df.select(logistic_nll("z", "y")).collect()]
    assert vals == pytest.approx([1000.0, 1000.0, 0.0])


def test_boundary_is_null_when_last_weight_is_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x1 double, x2 double")
    r = boundary_lines(df, HINGE_FEATURES, LinearModel([[0.5, 0.0]], [0.1]), {"b": 0.0}).first()
    assert r["b"] is None


def test_arrow_and_expression_scores_agree(spark):
    rows = class_rows(spark, SF_SMALL)
    m = LinearModel(np.linspace(-1, 1, 640).reshape(10, 64), np.arange(10) / 10.0)
    a = with_class_scores(rows, "features", m, "s", method="arrow").select("id", "s")
    b = with_class_scores(rows, "features", m, "s", method="expr").select("id", F.col("s").alias("t"))
    for r in a.join(b, "id").collect():
        np.testing.assert_allclose(r["s"], r["t"], rtol=1e-12, atol=1e-12)


def test_model_store_keeps_epochs_and_skips_rewrites(spark):
    store = ModelStore(spark, scratch_path(spark, "store"))
    assert store.last_epoch() is None
    assert store.write(LinearModel.from_vector([1.0, 2.0]).to_table(spark), 1)
    assert store.write(LinearModel.from_vector([3.0, 4.0]).to_table(spark), 2)
    assert not store.write(LinearModel.from_vector([9.0, 9.0]).to_table(spark), 2)
    assert store.epochs() == [1, 2]
    np.testing.assert_array_equal(LinearModel.from_table(store.latest()).vector(), [3.0, 4.0])


def test_stream_update_matches_batch_chain_and_replay_is_idempotent(spark):
    rows = stream_rows(spark, SF_SMALL)
    r = rows.agg(F.min("id"), F.max("id")).first()
    keyed = rows.withColumn("chunk", chunk_column("id", int(r[0]), int(r[1]), 3))
    cfg = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, shards=2, max_iter=1, tol=0.0, order="id")
    store = ModelStore(spark, scratch_path(spark, "online"))
    store.write(LinearModel.zeros(1, 2).to_table(spark), 0)
    upd = OnlineUpdate(store, "id", HINGE_FEATURES, "y", cfg)
    expect = LinearModel.zeros(1, 2)
    for c in range(3):
        batch = keyed.filter(F.col("chunk") == c).drop("chunk")
        upd(batch, c)
        expect, *_ = run_epoch(prepare_shards(batch, "id", HINGE_FEATURES, "y", 2), expect, c + 1, cfg)
    fresh = OnlineUpdate(store, "id", HINGE_FEATURES, "y", cfg)  # as after a restart
    fresh(keyed.filter(F.col("chunk") == 2).drop("chunk"), 2)   # replayed batch id
    assert store.epochs() == [0, 1, 2, 3]
    np.testing.assert_allclose(LinearModel.from_table(store.latest()).flat(), expect.flat(), rtol=1e-12)


def test_model_store_append_epochs_in_one_job(spark):
    from ridgeway.operators.sgd import models_table
    store = ModelStore(spark, scratch_path(spark, "store-many"))
    ms = [LinearModel.from_vector([float(e), 1.0]) for e in range(1, 4)]
    assert store.append_epochs(models_table(spark, ms, start=1)) == 3
    assert store.append_epochs(models_table(spark, ms, start=1)) == 0
    assert store.epochs() == [1, 2, 3]
    assert store.latest().filter("feature_idx = 0").first()["weight"] == 3.0


def test_streams_from_several_sources_on_one_store_equal_the_batch_chain(spark):
    from ridgeway.streaming.online import run_online_update, write_stream_chunks
    from ridgeway.plans.text_io import STREAM_SCHEMA
    rows = stream_rows(spark, SF_SMALL)  # 1000 events
    src = scratch_path(spark, "stream-src-test")
    folders = write_stream_chunks(rows.repartition(3), src, "id", 2)
    lo, hi = rows.agg(F.min("id"), F.max("id")).first()
    assert len(folders) == 2
    cfg = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, shards=2, max_iter=1, tol=0.0, order="id")
    store = ModelStore(spark, scratch_path(spark, "stream-store-test"))
    ckpt = [scratch_path(spark, "stream-ckpt-test") for _ in folders]
    for _ in range(2):  # the second round finds every source folded in and changes nothing
        for folder, c in zip(folders, ckpt):
            run_online_update(spark, folder, STREAM_SCHEMA, store, "id", HINGE_FEATURES, "y", cfg,
                              LinearModel.zeros(1, 2), c, max_files_per_trigger=None)
    keyed = rows.withColumn("chunk", chunk_column("id", lo, hi, 2))
    expect = LinearModel.zeros(1, 2)
    for c in range(2):
        batch = keyed.filter(F.col("chunk") == c).drop("chunk")
        expect, *_ = run_epoch(prepare_shards(batch, "id", HINGE_FEATURES, "y", 2), expect, c + 1, cfg)
    assert store.epochs() == [0, 1, 2]
    np.testing.assert_allclose(LinearModel.from_table(store.latest()).flat(), expect.flat(), rtol=1e-12)


@pytest.mark.parametrize("direct", [0, 100_000])
@pytest.mark.parametrize("n", [1, 7, 50, 149, 150, 400])
def test_first_n_by_is_exact(spark, monkeypatch, n, direct):
    from ridgeway.operators import sample
    from ridgeway.operators.sample import first_n_by
    monkeypatch.setattr(sample, "DIRECT_ROWS", direct)
    from ridgeway.sources.tables import hinge_rows
    rows = hinge_rows(spark, SF_SMALL).repartition(5)
    got = sorted(r["id"] for r in first_n_by(rows, "id", n, buckets=5, slack=1.5).collect())
    want = sorted(r["id"] for r in rows.orderBy("id").limit(n).collect())
    assert got == want


def test_blob_points_fall_in_their_class_boxes(spark):
    from ridgeway.sources.blobs import THREE_BLOBS, blob_table
    from ridgeway.sources.tables import hinge_rows
    pts = blob_table(hinge_rows(spark, SF_SMALL).select("id"), "id", THREE_BLOBS).toPandas()
    assert set(pts["y"]) == {0.0, 1.0, 2.0}
    for scale, offset, label in THREE_BLOBS:
        sel = pts[pts["y"] == label]
        for c in ("x1", "x2"):
            assert (sel[c] >= offset).all() and (sel[c] < offset + scale).all()


def test_model_size_guards_raise_instead_of_truncating(spark, monkeypatch):
    import ridgeway.model as model_mod
    table = LinearModel.zeros(2, 3).to_table(spark)          # 8 cells
    monkeypatch.setattr(model_mod, "MAX_MODEL_CELLS", 5)
    with pytest.raises(ValueError, match="limit"):
        LinearModel.from_table(table)
    with pytest.raises(ValueError, match="too large"):
        LinearModel.zeros(2, 3).to_table(spark)
    sparse = table.filter("feature_idx <> 2")
    monkeypatch.setattr(model_mod, "MAX_MODEL_CELLS", 100)
    with pytest.raises(ValueError, match="not dense"):
        LinearModel.from_table(sparse)


@pytest.mark.parametrize("fmt", ["lines", "record", "parquet"])
def test_model_round_trips_in_every_format(spark, fmt):
    from ridgeway.sources import read_model, write_model
    m = LinearModel.from_vector([0.5, -1.25, 3e-9, 7.0])
    path = scratch_path(spark, f"model-{fmt}")
    write_model(m.to_table(spark), path, fmt)
    np.testing.assert_array_equal(LinearModel.from_table(read_model(spark, path, fmt)).vector(), m.vector())


def test_store_commits_packs_and_keeps_every_epoch(spark, monkeypatch):
    from ridgeway.operators.sgd import models_table
    from ridgeway.sources import model_store
    path = scratch_path(spark, "store-log")
    store = ModelStore(spark, path)
    model = lambda e: LinearModel(np.full((2, 3), float(e)), [e + 0.5, -e])
    for e in range(6):
        assert store.write(model(e), e, stream="s", batch=e * 10, history=(e, 7, 0.1 * e, None, e == 5))
    monkeypatch.setattr(model_store, "INLINE_CELLS", 8)
    assert store.write(model(6), 6)                                        # still in its record
    assert store.append_epochs(models_table(spark, [model(e) for e in (6, 7, 8)], start=6)) == 2   # a packed file, without epoch 6
    fresh = ModelStore(spark, path)                                        # as after a restart
    for _ in range(2):
        assert fresh.epochs() == list(range(9)) and fresh.last_epoch() == 8 and fresh.last_batch("s") == 50 and fresh.last_batch("t") is None
        for e in range(9):
            np.testing.assert_array_equal(fresh.read_model(e).flat(), model(e).flat())
            assert fresh.read_epoch(e).count() == 8 and fresh.read_epoch(e).select("epoch").first()[0] == e
        assert fresh.histories() == [(e, 7, 0.1 * e, None, e == 5) for e in range(6)]
        fresh.compact()
    assert len(fresh.records()) == 2 and fresh.compact() == 0
    with pytest.raises(ValueError, match="not stored"):
        fresh.read_epoch(9)
    with pytest.raises(ValueError, match="consecutive"):
        fresh.append_epochs(models_table(spark, [model(1), model(2)], start=9).where("epoch <> 9 or feature_idx > 0"))
    fresh.log.commit("000000000099-000000000099-000000000099.txt", "no record")   # other files are no commits
    assert fresh.last_epoch() == 8


def test_ordered_stream_resumes_after_a_kill_and_waits_for_gaps(spark):
    from ridgeway.plans.text_io import STREAM_SCHEMA
    from ridgeway.streaming import online
    rows = stream_rows(spark, SF_SMALL)
    cfg = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, shards=2, max_iter=1, tol=0.0, order="id")
    paths = online.write_stream_chunks(rows.repartition(3), scratch_path(spark, "ordered-src"), "id", 4)
    expect = [LinearModel.zeros(1, 2)]
    for k, p in enumerate(paths):
        batch = spark.read.schema(STREAM_SCHEMA).parquet(p)
        expect.append(run_epoch(prepare_shards(batch, "id", HINGE_FEATURES, "y", 2), expect[-1], k + 1, cfg)[0])
    manifest, ckpt = scratch_path(spark, "manifest"), scratch_path(spark, "ordered-ckpt")
    store = ModelStore(spark, scratch_path(spark, "ordered-store"))
    run = lambda: online.run_ordered_update(spark, manifest, STREAM_SCHEMA, store, "id", HINGE_FEATURES, "y", cfg,
                                            LinearModel.zeros(1, 2), ckpt)

    online.write_manifest(spark, paths[2:3], manifest, first=2)    # came too early: waits
    run()
    assert store.epochs() == [0]
    online.write_manifest(spark, paths[:2], manifest)
    real, calls = ModelStore.write, []

    def dies(self, model, epoch, **kw):                            # the driver is lost while batch 1 commits
        calls.append(epoch)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(self, model, epoch, **kw)

    ModelStore.write = dies
    try:
        with pytest.raises(Exception, match="lost"):
            run()
    finally:
        ModelStore.write = real
    assert store.epochs() == [0, 1]
    run()                                                          # resumes, and takes the batch that waited
    assert store.epochs() == [0, 1, 2, 3]
    online.write_manifest(spark, paths[3:], manifest, first=3)
    run()
    run()                                                          # nothing new: nothing changes
    assert store.epochs() == [0, 1, 2, 3, 4]
    for e, m in enumerate(expect):
        np.testing.assert_allclose(store.read_model(e).flat(), m.flat(), rtol=1e-12, atol=1e-15)
    online.write_manifest(spark, [paths[0], paths[1]], manifest, first=4)
    online.write_manifest(spark, [paths[2]], manifest, first=4)    # batch 4 named twice
    with pytest.raises(Exception, match="twice"):
        run()
