"""Model tables in the three on-disk formats: ``idx,weight`` lines, a
``weights,w0,...`` record, or a Parquet model table.  Models are K*(d+1)
cells, so every write goes to a single file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridgeway.sources.text import (read_weight_lines, read_weight_record, write_weight_lines,
                                   write_weight_record)

FORMATS = ("lines", "record", "parquet")


def read_model(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``class_idx, feature_idx, weight`` from a stored model."""
    if fmt == "lines":
        return read_weight_lines(spark, path)
    if fmt == "record":
        return read_weight_record(spark, path)
    if fmt == "parquet":
        return spark.read.parquet(path).select("class_idx", "feature_idx", "weight")
    raise ValueError(f"format must be one of {FORMATS}")


def write_model(model: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store a model table (lines and record hold a single-output model)."""
    if fmt == "lines":
        write_weight_lines(model, path)
    elif fmt == "record":
        write_weight_record(model, path)
    elif fmt == "parquet":
        model.select("class_idx", "feature_idx", "weight").coalesce(1) \
             .write.mode("errorifexists").parquet(path)
    else:
        raise ValueError(f"format must be one of {FORMATS}")
