"""Text scans and sinks, the epoch-partitioned model store, and the streaming
online update.  Everything is written to fresh paths in the shared scratch area
and read back with Spark readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeway.model import LinearModel
from ridgeway.operators.gd import train_gd
from ridgeway.operators.sgd import SGDConfig, models_table
from ridgeway.plans import sqlgen as S
from ridgeway.plans.full_batch import GD_LINEAR_L2, _gd_sql, _step_model, _step_sql
from ridgeway.plans.registry import query, rnd, round_model
from ridgeway.session import scratch_path
from ridgeway.sources.model_store import ModelStore
from ridgeway.sources.tables import HINGE_FEATURES, LIN_FEATURES, hinge_rows, lin_rows, stream_rows
from ridgeway.sources.text import (RECORD_TAG, read_csv_rows, read_tsv_rows, read_weight_lines,
                                   read_weight_record, write_labelled_text, write_weight_lines,
                                   write_weight_record)
from ridgeway.streaming.online import run_ordered_update, write_manifest, write_stream_chunks

STEP_MODEL_SQL = S.model_rows_sql(f"({_step_sql()})", ["s0", "s1", "s2", "s3"])


@query("scan_tsv_rows", f"SELECT y, x1, x2 FROM ({S.HINGE_ROWS}) r")
def q_scan_tsv_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whole customer fixture written as label-first TSV, then scanned with a fixed schema."""
    path = scratch_path(spark, "tsv-rows")
    write_labelled_text(hinge_rows(spark, sf), path, "y", HINGE_FEATURES, "\t")
    return read_tsv_rows(spark, path, len(HINGE_FEATURES))


@query("scan_csv_rows", f"SELECT y, x1, x2 FROM ({S.HINGE_ROWS}) r")
def q_scan_csv_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv-rows")
    write_labelled_text(hinge_rows(spark, sf), path, "y", HINGE_FEATURES, ",")
    return read_csv_rows(spark, path, len(HINGE_FEATURES))


@query("scan_weight_lines", STEP_MODEL_SQL)
def q_scan_weight_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A one-step GD model written as ``idx,weight`` lines and scanned back."""
    path = scratch_path(spark, "weight-lines")
    write_weight_lines(_step_model(spark, sf), path)
    return round_model(read_weight_lines(spark, path))


@query("sink_weight_lines", STEP_MODEL_SQL)
def q_sink_weight_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The weight-lines sink, checked by reading its raw text lines."""
    path = scratch_path(spark, "weight-lines-sink")
    write_weight_lines(_step_model(spark, sf), path)
    toks = F.split(F.col("value"), ",")
    raw = spark.read.text(path).select(F.lit(0).alias("class_idx"),
                                       toks.getItem(0).cast("int").alias("feature_idx"),
                                       toks.getItem(1).cast("double").alias("weight"))
    return round_model(raw)


@query("scan_weight_record", STEP_MODEL_SQL)
def q_scan_weight_record(spark: SparkSession, sf: str) -> DataFrame:
    """A one-step GD model written as one ``weights,w0,...,wd`` line and scanned back."""
    path = scratch_path(spark, "weight-record")
    write_weight_record(_step_model(spark, sf), path)
    return round_model(read_weight_record(spark, path))


@query("sink_weight_record",
       f"SELECT '{RECORD_TAG}' AS tag, 1::BIGINT AS n_lines, 4::INTEGER AS n_weights, "
       f"{S.rnd('s0 + s1 + s2 + s3')} AS weight_sum FROM ({_step_sql()}) st")
def q_sink_weight_record(spark: SparkSession, sf: str) -> DataFrame:
    """The weight-record sink, checked on its raw text: one line, a tag, d+1 numbers."""
    path = scratch_path(spark, "weight-record-sink")
    write_weight_record(_step_model(spark, sf), path)
    toks = F.split(F.col("value"), ",")
    vals = F.transform(F.slice(toks, 2, F.size(toks) - 1), lambda t: t.cast("double"))
    per_line = spark.read.text(path).select(
        toks.getItem(0).alias("tag"), F.size(vals).cast("int").alias("n_weights"),
        F.aggregate(vals, F.lit(0.0), lambda a, v: a + v).alias("wsum"))
    return per_line.groupBy("tag").agg(F.count(F.lit(1)).alias("n_lines"),
                                       F.max("n_weights").alias("n_weights"),
                                       rnd(F.sum("wsum")).alias("weight_sum"))


@query("model_store_latest",
       _gd_sql(S.LIN_ROWS, GD_LINEAR_L2)
       + ",\nlast AS (SELECT * FROM gd WHERE epoch = (SELECT max(epoch) FROM gd))\n"
       + "SELECT class_idx, feature_idx, weight, (SELECT CAST(max(epoch) AS INTEGER) FROM gd) AS epoch FROM ("
       + S.model_rows_sql("last", ["w0", "w1", "w2", "w3"]) + ") m")
def q_model_store_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Every epoch's model of a GD run appended to the model store in one commit;
    the newest is read back (older ones are kept, never deleted)."""
    res = train_gd(lin_rows(spark, sf), LIN_FEATURES, "y", GD_LINEAR_L2, keep_models=True)
    store = ModelStore(spark, scratch_path(spark, "model-store"))
    store.append_epochs(models_table(spark, res.models, start=1))
    latest = store.latest()
    return latest.select(F.col("class_idx").cast("int"), F.col("feature_idx").cast("int"),
                         rnd("weight").alias("weight"), "epoch")


# ---- streaming online update ----------------------------------------------

STREAM_CHUNKS = 8
STREAM_CFG = SGDConfig(kind="hinge", alpha=0.01, l2=1.0, shards=4, max_iter=1, tol=0.0, order="id")
STREAM_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("x1", T.DoubleType()),
                              T.StructField("x2", T.DoubleType()), T.StructField("y", T.DoubleType())])


def _stream_sql() -> str:
    span = "((SELECT max(event_id) FROM events) - (SELECT min(event_id) FROM events) + 1)"
    chunk = f"((id - (SELECT min(event_id) FROM events)) * {STREAM_CHUNKS}) // {span}"
    st = S.sgd_state("hinge", 1, 2, STREAM_CFG.alpha, STREAM_CFG.l2)
    return (S.sgd_chain_sql(S.STREAM_ROWS, st, STREAM_CFG.shards, STREAM_CHUNKS, STREAM_CFG.tol, "id",
                            S.hinge_init([0.0, 0.0], 0.0), chunk_expr=chunk)
            + "\n" + st.model_rows("final", 6))


@query("stream_online_hinge", _stream_sql())
def q_stream_online_hinge(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive in id order as eight batches of a manifest, followed by one stream; each
    batch folds into the stored hinge model (4 shards, averaged), starting from zero."""
    batches = write_stream_chunks(stream_rows(spark, sf), scratch_path(spark, "stream-src"), "id", STREAM_CHUNKS)
    store = ModelStore(spark, scratch_path(spark, "stream-models"))
    manifest = write_manifest(spark, batches, scratch_path(spark, "stream-manifest"))
    run_ordered_update(spark, manifest, STREAM_SCHEMA, store, "id", HINGE_FEATURES, "y", STREAM_CFG,
                       LinearModel.zeros(1, 2), scratch_path(spark, "stream-ckpt"))
    return round_model(store.latest())
