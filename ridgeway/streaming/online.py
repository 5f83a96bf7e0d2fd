"""Online model update on a stream of labelled rows (Structured Streaming).

Each micro-batch runs one averaged SGD pass (``sgd_pass``) that starts from the newest
model in a :class:`~ridgeway.sources.model_store.ModelStore` and appends its result as the
next epoch (epoch 0 is the initial model), together with the stream's name and the
batch id.  A replayed batch finds its own (stream, batch) in the store and does nothing, so
restarts after executor or driver loss are idempotent, and any number of streams can feed
one store, one after another.  :func:`run_ordered_update` folds batches in an order that a manifest gives.  The stream's checkpoint is required: it names the stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeway.model import LinearModel
from ridgeway.operators.sgd import SGDConfig, sgd_pass
from ridgeway.sources.model_store import ModelStore


@dataclass
class OnlineUpdate:
    store: ModelStore
    id_col: str
    features: Sequence[str] | str
    label: str
    cfg: SGDConfig
    stream: str = "stream"

    # (batch, epoch, model) last written by this process: saves re-reading the store
    # on every micro-batch; after a restart the store is read once.
    _current: tuple[int, int, LinearModel] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch_id = int(batch_id)
        if self._current is None:
            done, epoch = self.store.last_batch(self.stream), self.store.last_epoch()
            self._current = (-1 if done is None else done, epoch, self.store.read_model(epoch))
        done, epoch, model = self._current
        if batch_id <= done:
            return  # replay of a batch that is already folded in
        if self.cfg.rows_per_shard is None:  # exact shards: the batch is read once
            new, _, _ = sgd_pass(batch, self.id_col, self.features, self.label, self.cfg, model, epoch + 1)
        else:
            # the micro-batch is read twice (row count for the shards, then the fold)
            held = batch.persist(StorageLevel.MEMORY_AND_DISK_DESER)
            try:
                new, _, _ = sgd_pass(held, self.id_col, self.features, self.label, self.cfg, model, epoch + 1)
            finally:
                held.unpersist()
        self.store.write(new, epoch + 1, stream=self.stream, batch=batch_id)
        self._current = (batch_id, epoch + 1, new)


def run_online_update(spark: SparkSession, source: str, schema: T.StructType, store: ModelStore,
                      id_col: str, features: Sequence[str] | str, label: str, cfg: SGDConfig,
                      init: LinearModel, checkpoint: str, max_files_per_trigger: int | None = 1,
                      stream: str | None = None) -> ModelStore:
    """Fold every file available under ``source`` into the stored model, then stop.
    ``checkpoint`` is the stream's own folder and, unless ``stream`` is given, its name;
    ``max_files_per_trigger=None`` takes all files as one micro-batch."""
    if not checkpoint:
        raise ValueError("a stream needs its own checkpoint folder")
    if store.last_epoch() is None:
        store.write(init, 0)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(source).writeStream
         .trigger(availableNow=True)
         .option("checkpointLocation", checkpoint)
         .foreachBatch(OnlineUpdate(store, id_col, features, label, cfg, stream or checkpoint.rstrip("/")))
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return store


def run_ordered_update(spark: SparkSession, manifest: str, schema: T.StructType, store: ModelStore,
                       id_col: str, features: Sequence[str] | str, label: str, cfg: SGDConfig,
                       init: LinearModel, checkpoint: str, stream: str | None = None) -> ModelStore:
    """Fold the batches of a manifest into the stored model, in their numbers' order, then stop.

    ONE streaming query follows the folder of manifest rows ``(batch long, path string)``: they, not the times of
    files, say which rows a batch holds and when its turn is.  Each trigger reads the
    rows behind the newest folded batch and folds those that follow it without a gap; a row that came before its
    predecessor waits in the manifest.  Every batch commits its model together with (stream, batch), so a run that was
    killed at any point resumes to the same model."""
    if not checkpoint:
        raise ValueError("a stream needs its own checkpoint folder")
    if store.last_epoch() is None:
        store.write(init, 0)
    name = stream or checkpoint.rstrip("/")
    fold = OnlineUpdate(store, id_col, features, label, cfg, name)

    def turn(arrived: DataFrame, _: int) -> None:
        done = store.last_batch(name)
        next_batch = 0 if done is None else done + 1
        listed = spark.read.schema(MANIFEST).json(manifest).where(F.col("batch") >= F.lit(next_batch))
        due = {}
        for row in listed.collect():                                  # names of the batches to come
            if due.setdefault(row["batch"], row["path"]) != row["path"]:
                raise ValueError(f"manifest names batch {row['batch']} twice")
        while next_batch in due:
            fold(spark.read.schema(schema).parquet(due[next_batch]), next_batch)
            next_batch += 1

    q = (spark.readStream.schema(MANIFEST).json(manifest).writeStream.trigger(availableNow=True)
         .option("checkpointLocation", checkpoint).foreachBatch(turn).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return store


MANIFEST = "batch long, path string"


def write_manifest(spark: SparkSession, paths: Sequence[str], manifest: str, first: int = 0) -> str:
    """Append manifest rows that number ``paths`` from ``first`` on, as one file."""
    rows = [(first + k, p) for k, p in enumerate(paths)]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").json(manifest)
    return manifest


def chunk_column(id_col: str, lo: int, hi: int, n_chunks: int):
    """Chunk index of a row: ``(id - lo) * n div (hi - lo + 1)`` (contiguous id ranges)."""
    span = hi - lo + 1
    return F.expr(f"CAST((({id_col} - {lo}) * {n_chunks}) div {span} AS INT)")


def write_stream_chunks(rows: DataFrame, path: str, id_col: str, n_chunks: int) -> list[str]:
    """``rows`` as ``n_chunks`` id-range chunks, each a folder of its own, oldest first -- a
    stand-in for arrivals.  One write job; which rows a chunk holds is in the data, not in
    the order or time of writes.  Returns the folders of the chunks, in order."""
    r = rows.agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).collect()[0]
    if r["lo"] is None:
        return []
    keyed = rows.withColumn("chunk", chunk_column(id_col, int(r["lo"]), int(r["hi"]), n_chunks))
    keyed.write.partitionBy("chunk").parquet(path)
    found = [c["chunk"] for c in keyed.select("chunk").distinct().collect()]  # at most n_chunks
    return [f"{path}/chunk={c}" for c in sorted(found)]
