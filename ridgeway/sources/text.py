"""Delimited-text labelled rows and the two text weight formats.

* labelled rows, label first: ``y<sep>x1<sep>...<sep>xd`` (TSV or CSV, no header)
* weight lines: ``idx,weight`` per line (idx 0 = intercept)
* weight record: one line ``weights,w0,w1,...,wd`` (the first token is a tag)

Labelled lines are split and cast by the reader here, and every field of every line is
checked, whichever columns are selected later: ragged lines, empty fields, blank lines
and non-numeric fields raise.  Weight files use explicit schemas and FAILFAST.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_TAG = "weights"


def labelled_schema(n_features: int, label: str = "y", prefix: str = "x") -> T.StructType:
    fields = [T.StructField(label, T.DoubleType(), False)]
    fields += [T.StructField(f"{prefix}{i}", T.DoubleType(), False) for i in range(1, n_features + 1)]
    return T.StructType(fields)


def read_labelled_text(spark: SparkSession, path: str, n_features: int, sep: str = "\t",
                       label: str = "y", prefix: str = "x") -> DataFrame:
    names = labelled_schema(n_features, label, prefix).fieldNames()
    tokens = F.split(F.col("value"), f"\\Q{sep}\\E", -1)
    fields = [tokens[i].try_cast("double") for i in range(len(names))]
    good = F.size(tokens) == len(names)
    for f in fields:
        good = good & f.isNotNull()
    line = F.when(good, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("malformed labelled line: "), F.col("value"))).cast("boolean"))
    return spark.read.text(path).where(line).select(*[f.alias(n) for f, n in zip(fields, names)])


def read_tsv_rows(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    return read_labelled_text(spark, path, n_features, "\t")


def read_csv_rows(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    return read_labelled_text(spark, path, n_features, ",")


def write_labelled_text(df: DataFrame, path: str, label: str, features: Sequence[str],
                        sep: str = "\t") -> None:
    (df.select(F.col(label).cast("double"), *[F.col(c).cast("double") for c in features])
       .write.mode("errorifexists").option("sep", sep).option("header", "false").csv(path))


# ---- weight lines ------------------------------------------------------

WEIGHT_LINE_SCHEMA = T.StructType([
    T.StructField("feature_idx", T.IntegerType(), False),
    T.StructField("weight", T.DoubleType(), False),
])


def _single_output(model: DataFrame) -> DataFrame:
    """The text formats have no class: a model of several classes raises, none is dropped."""
    if not model.filter(F.col("class_idx") != F.lit(0)).isEmpty():
        raise ValueError("text weight formats hold a single-output model; store a K-class model as parquet")
    return model


def write_weight_lines(model: DataFrame, path: str) -> None:
    """``idx,weight`` lines of a single-output model table."""
    (_single_output(model)
          .select("feature_idx", "weight")
          .coalesce(1)  # d+1 lines; one file keeps the format a single list
          .write.mode("errorifexists").option("header", "false").csv(path))


def read_weight_lines(spark: SparkSession, path: str) -> DataFrame:
    df = (spark.read.schema(WEIGHT_LINE_SCHEMA).option("header", "false")
          .option("mode", "FAILFAST").csv(path))
    return df.select(F.lit(0).alias("class_idx"), "feature_idx", "weight")


# ---- weight record -----------------------------------------------------

def weight_record_line(model: DataFrame) -> DataFrame:
    """One-row ``value`` column: ``weights,w0,...,wd`` ordered by feature index.

    The group is the model itself (d+1 cells), never data rows.
    """
    ordered = (_single_output(model)
                    .agg(F.array_sort(F.collect_list(F.struct("feature_idx", "weight"))).alias("ws")))
    tokens = F.transform(F.col("ws"), lambda s: s["weight"].cast("string"))
    return ordered.select(F.concat_ws(",", F.array(F.lit(RECORD_TAG)), tokens).alias("value"))


def write_weight_record(model: DataFrame, path: str) -> None:
    weight_record_line(model).coalesce(1).write.mode("errorifexists").text(path)


def parse_weight_record(lines: DataFrame) -> DataFrame:
    """``value`` lines -> ``(class_idx, feature_idx, weight)``; the tag is skipped."""
    toks = F.split(F.col("value"), ",")
    vals = F.slice(toks, 2, F.size(toks) - 1)
    return (lines.select(F.posexplode(vals).alias("feature_idx", "tok"))
                 .select(F.lit(0).alias("class_idx"),
                         F.col("feature_idx").cast("int").alias("feature_idx"),
                         F.col("tok").cast("double").alias("weight")))


def read_weight_record(spark: SparkSession, path: str) -> DataFrame:
    return parse_weight_record(spark.read.text(path))
