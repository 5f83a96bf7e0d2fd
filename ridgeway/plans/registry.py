"""Named queries and their DuckDB oracle SQL.

``@query(name, sql)`` registers a ``(spark, sf_dir) -> DataFrame`` callable;
``sql`` is the equivalent DuckDB statement over the raw tables (None when
the operator has no SQL form).  Floating outputs are rounded identically on
both sides (``round(x, k) + 0.0``; the ``+ 0.0`` folds -0.0 into 0.0).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rnd(c: Column | str, digits: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, digits) + F.lit(0.0)


def round_model(model: DataFrame, digits: int = 6) -> DataFrame:
    return model.select(F.col("class_idx").cast("int"), F.col("feature_idx").cast("int"),
                        rnd("weight", digits).alias("weight"))


def round_history(hist: DataFrame, digits: int = 6) -> DataFrame:
    return hist.select("epoch", "n_rows", rnd("loss", digits).alias("loss"),
                       rnd("param_delta", digits).alias("param_delta"), "stopped")
