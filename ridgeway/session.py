"""Session and shared-scratch helpers.

Anything this library writes between jobs (text fixtures, model stores,
stream checkpoints) goes below the cluster's ``spark.checkpoint.dir`` so that
it is visible to every executor and survives executor loss.  A directory is
only invented when the session has none (local runs and tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str = "local[*]", app: str = "ridgeway",
                shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:  # else Spark's own setting stands
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update({k: str(v) for k, v in extra.items()})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Read from the running context first, then from ``spark.checkpoint.dir``;
    only when both are unset and the master is local is a fresh local folder created
    and registered, so later ``checkpoint()`` calls and our scratch writes agree; on a
    cluster that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="ridgeway-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused path in the shared scratch area."""
    return f"{checkpoint_dir(spark)}/ridgeway-{tag}-{uuid.uuid4().hex[:12]}"
