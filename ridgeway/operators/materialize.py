"""Keeping an input between the epochs of an iterative job.

``persist``    MEMORY_AND_DISK_DESER blocks (the DataFrame default: cached column
               batches are scanned without deserialising); a lost block is
               recomputed from its lineage.
``checkpoint`` a reliable checkpoint in the shared ``spark.checkpoint.dir``: lineage is
               cut, so executor loss never re-runs the scan or the shuffle before it.
               Partitioning (e.g. one shard per partition) is preserved.
``none``       re-read every epoch (inputs far larger than the cluster's disks).
"""

from __future__ import annotations

from pyspark import RDD, StorageLevel
from pyspark.sql import SparkSession

from ridgeway.session import checkpoint_dir

MODES = ("persist", "checkpoint", "none")


def materialize(df, mode: str):
    """-> (frame to iterate on, frame to release afterwards or None); also for an RDD of blocks."""
    if mode not in MODES:
        raise ValueError(f"materialize must be one of {MODES}")
    if isinstance(df, RDD):
        if mode != "none":
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
        if mode == "checkpoint":
            checkpoint_dir(SparkSession.active())
            df.checkpoint()      # written when the first pass runs; later passes and lost blocks read it
        return df, df if mode != "none" else None
    if mode == "persist":
        p = df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
        return p, p
    if mode == "checkpoint":
        checkpoint_dir(df.sparkSession)  # make sure the session names a folder
        return df.checkpoint(eager=True), None
    return df, None


def release(df) -> None:
    if df is not None:
        df.unpersist()
