"""Per-epoch training log in the shared folder, so a restarted driver resumes.

Executors lost mid-epoch are recovered by Spark itself (lineage); this covers
the driver loop.  Each epoch commits its model and its history row in one record of a
:class:`~ridgeway.sources.model_store.ModelStore`.  A trainer given the same log
continues after the last epoch found there (history included), so the result
equals an uninterrupted run.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ridgeway.model import LinearModel
from ridgeway.sources.model_store import ModelStore

_HISTORY_DDL = "epoch int, n_rows long, loss double, param_delta double, stopped boolean"


class TrainingLog:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.models = ModelStore(spark, f"{self.path}/models")

    def record(self, row: tuple, model: LinearModel) -> None:
        """The model and its history row, together.  An epoch that is stored without a row (a model
        written by other means) is committed once more, with it."""
        self.models.write(model, int(row[0]), history=row)

    def resume(self) -> tuple[list[tuple], LinearModel] | None:
        """(history rows in epoch order, model after the last of them), or None."""
        rows = self.models.histories()
        return (rows, self.models.read_model(rows[-1][0])) if rows else None

    def history_table(self):
        return self.spark.createDataFrame(self.models.histories(), _HISTORY_DDL).orderBy("epoch")
