"""Connected components of a table of links, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.session import scratch_path


def store(df: DataFrame, tag: str) -> DataFrame:
    """The rows as a table in the shared folder: cuts the lineage, survives executors.

    What the written plan shuffled is not needed any more.  Spark removes shuffle files when the
    driver's JVM collects their owners, so a collection is asked for: the disk holds the
    shuffles of a step, not of the whole run."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join on ``key`` where ``left`` may hold very many rows of one key and ``right`` has one
    row a key.  The second key (a hash of the first) makes both sides shuffled inputs of the
    join, also where one is an aggregate by the key, so that adaptive execution splits a
    key's rows over tasks."""
    l = left.withColumn("__h", F.xxhash64(F.col(key)))
    r = right.withColumn("__h", F.xxhash64(F.col(key)))
    return l.join(r, [key, "__h"], how).drop("__h")


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return (join_hot(both, near, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _smallest(down)
    moved = join_hot(down, near, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(near.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links -> one row (u, v) per linked node that is not the smallest of its component;
    v is the smallest.  Large-star and small-star passes alternate until nothing moves;
    the number of rows never grows."""
    edges = store(links.select("u", "v").where("u != v").distinct(), "links")
    seen = _state(edges)
    while seen[0]:
        edges = store(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == seen:
            break
        seen = now
    return edges
