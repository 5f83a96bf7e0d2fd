"""Parquet table access and the labelled-row views derived from it.

Each view selects only the columns it needs so the Parquet scan's
``ReadSchema`` is pruned to them; the derived features are plain
expressions evaluated inside the scan's codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LIN_FEATURES = ["x1", "x2", "x3"]
HINGE_FEATURES = ["x1", "x2"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_returnflag",
        (F.col("l_extendedprice") / F.lit(100000.0)).alias("price_scaled"),
        (F.col("l_quantity") / F.lit(50.0)).alias("x1"),
        (F.col("l_discount") * F.lit(10.0)).alias("x2"),
        (F.col("l_tax") * F.lit(12.5)).alias("x3"),
    )


def lin_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regression rows from lineitem: y = price/1e5, x = (qty/50, disc*10, tax*12.5)."""
    f = _lineitem_features(spark, sf_dir)
    return f.select("l_orderkey", "l_linenumber", F.col("price_scaled").alias("y"), *LIN_FEATURES)


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary 0/1 rows from lineitem: y = 1 when the line was returned ('R')."""
    f = _lineitem_features(spark, sf_dir)
    y = F.when(F.col("l_returnflag") == F.lit("R"), F.lit(1.0)).otherwise(F.lit(0.0))
    return f.select("l_orderkey", "l_linenumber", y.alias("y"), *LIN_FEATURES)


def hinge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """+-1 rows from customer, keyed by the unique ``c_custkey``."""
    c = read_table(spark, sf_dir, "customer")
    y = F.when((F.col("c_mktsegment") == F.lit("BUILDING")) | (F.col("c_acctbal") > F.lit(4500.0)),
               F.lit(1.0)).otherwise(F.lit(-1.0))
    return c.select(
        F.col("c_custkey").alias("id"),
        (F.col("c_acctbal") / F.lit(10000.0)).alias("x1"),
        (F.col("c_nationkey") / F.lit(25.0)).alias("x2"),
        y.alias("y"),
    )


def class_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-class rows from embeddings: ``features array<double>``, ``label int``."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").cast("int").alias("label"),
    )


def stream_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """+-1 rows from events (purchase vs. not), keyed by ``event_id``."""
    ev = read_table(spark, sf_dir, "events")
    y = F.when(F.col("event_type") == F.lit("purchase"), F.lit(1.0)).otherwise(F.lit(-1.0))
    return ev.select(
        F.col("event_id").alias("id"),
        (F.col("value") / F.lit(500.0)).alias("x1"),
        (F.hour("ts").cast("double") / F.lit(24.0)).alias("x2"),
        y.alias("y"),
    )
