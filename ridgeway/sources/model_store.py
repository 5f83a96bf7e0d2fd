"""Model store: a log of small commit records, the newest found by its name.

Every write commits one record ``<commit>-<first epoch>-<last epoch>.json`` under ``log/``, renamed into place.
A record holds the models themselves while they are at most ``INLINE_CELLS`` numbers (one file, no Spark
job), else it names a Parquet file under ``packed/`` with the models of many epochs, sorted by epoch, so that a filter on the epoch
reads their row groups alone.  Beside the models it carries, in the same commit, the history row of the epoch and
for each stream the newest micro-batch that is folded in (carried from record to record), so a
model and what made it are there together or not at all.

The store opens in one listing however many epochs it holds, and ``compact`` packs records into one.
No model is ever lost: epochs are never overwritten, and re-writing one that is stored is a no-op
(replayed stream batches stay idempotent).  One driver writes a store at a time.
"""

from __future__ import annotations

import base64
import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeway.model import MAX_MODEL_CELLS, LinearModel
from ridgeway.sources.files import SharedFolder

# Models (of one or many epochs) up to this many numbers live in the record itself.
INLINE_CELLS = 65_536

_TABLE = "class_idx int, feature_idx int, weight double, epoch int"


class ModelStore:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.log = SharedFolder(spark, f"{self.path}/log")

    # ---- the log ---------------------------------------------------------
    def records(self) -> list[tuple[int, int, int, str]]:
        """(commit, first epoch, last epoch, name) of every record, oldest first; one listing."""
        return sorted((*map(int, n.removesuffix(".json").split("-")), n) for n in self.log.names() if n.endswith(".json"))

    def newest(self) -> dict | None:
        found = self.records()
        return json.loads(self.log.read(found[-1][3])) if found else None

    def epochs(self) -> list[int]:
        return sorted({e for _, first, last, _ in self.records() for e in range(first, last + 1)})

    def last_epoch(self) -> int | None:
        return max((last for _, _, last, _ in self.records()), default=None)

    def last_batch(self, stream: str) -> int | None:
        """The newest batch of a stream that is folded into a stored model."""
        record = self.newest()
        return None if record is None else record["streams"].get(stream)

    def _commit(self, first: int, last: int, body: dict, found, history=None, stream: str | None = None, batch: int | None = None) -> None:
        streams = json.loads(self.log.read(found[-1][3]))["streams"] if found else {}
        if stream is not None:
            streams[stream] = int(batch)
        commit = found[-1][0] + 1 if found else 0
        record = {"first": first, "last": last, "streams": streams, "history": history, **body}
        self.log.commit(f"{commit:012d}-{first:012d}-{last:012d}.json", json.dumps(record))

    # ---- writing ---------------------------------------------------------
    def write(self, model: DataFrame | LinearModel, epoch: int, *, stream: str | None = None, batch: int | None = None,
              history: tuple | None = None) -> bool:
        """Append ``model`` as ``epoch``; False when that epoch already exists.
        ``stream`` and ``batch`` record which micro-batch made it.  With ``history`` (a row) an epoch whose
        record has none is committed once more, with it."""
        found, epoch = self.records(), int(epoch)
        last = max((r[2] for r in found), default=None)
        if last is not None and epoch <= last and (history is None or epoch < last):
            return False
        model = model if isinstance(model, LinearModel) else LinearModel.from_table(model)
        self._commit(epoch, epoch, self._body([model], epoch), found, history and list(history), stream, batch)
        return True

    def append_epochs(self, models: DataFrame) -> int:
        """Append a stack of models (``epoch, class_idx, feature_idx, weight``) in ONE commit; epochs already
        stored are skipped, and the others must follow one another.  Returns the epochs written."""
        found = self.records()
        last = max((r[2] for r in found), default=None)
        new = models.select("class_idx", "feature_idx", "weight", F.col("epoch").cast("int"))
        new = new if last is None else new.filter(F.col("epoch") > F.lit(int(last)))
        r = new.agg(F.count(F.lit(1)).alias("cells"), F.min("epoch").alias("a"), F.max("epoch").alias("b"),
                    F.countDistinct("epoch").alias("n"), F.max("class_idx").alias("k"), F.max("feature_idx").alias("d")).first()
        if not r["cells"]:
            return 0
        if r["n"] != r["b"] - r["a"] + 1 or r["cells"] != r["n"] * (r["k"] + 1) * (r["d"] + 1):
            raise ValueError("models must be dense and their epochs consecutive")
        self._commit(r["a"], r["b"], self._pack_table(new, r["cells"], r["k"] + 1, r["d"]), found)
        return r["n"]

    def _body(self, models: list[LinearModel], first: int) -> dict:
        k, d = models[0].n_classes, models[0].n_features
        flat = np.concatenate([m.flat() for m in models])
        if flat.size > MAX_MODEL_CELLS:
            raise ValueError("model too large for the store")
        if flat.size <= INLINE_CELLS:
            return {"k": k, "d": d, "weights": base64.b64encode(flat.astype("<f8").tobytes()).decode()}
        return {"k": k, "d": d, "file": self._pack(self.spark.createDataFrame(_table(flat, k, d, first)).repartition(1))}

    def _pack_table(self, models: DataFrame, cells: int, k: int, d: int) -> dict:
        if cells > INLINE_CELLS:
            return {"k": k, "d": d, "file": self._pack(models.repartition(1))}
        t = models.orderBy("epoch", "class_idx", "feature_idx").toArrow()   # checked: at most INLINE_CELLS rows
        return {"k": k, "d": d, "weights": base64.b64encode(t["weight"].to_numpy().astype("<f8").tobytes()).decode()}

    def _pack(self, models: DataFrame) -> str:
        """One Parquet file of many epochs, in their order; read only once its record is committed."""
        name = f"packed/{uuid.uuid4().hex}"
        models.sortWithinPartitions("epoch", "class_idx", "feature_idx").write.parquet(f"{self.path}/{name}")
        return name

    def compact(self) -> int:
        """Pack the records that hold their models themselves into one Parquet file under one record (histories are kept
        in it); returns how many were packed.  A reader finds every epoch before, meanwhile and after."""
        found = self.records()
        bodies = [(r, json.loads(self.log.read(r[3]))) for r in found]
        inline = [(r, b) for r, b in bodies if "weights" in b]
        if len(inline) < 2:
            return 0
        k, d = inline[-1][1]["k"], inline[-1][1]["d"]
        epochs: dict[int, np.ndarray] = {}
        history: dict[int, list] = {}
        for r, b in inline:
            flat = _weights(b).reshape(r[2] - r[1] + 1, -1)
            epochs.update(zip(range(r[1], r[2] + 1), flat))
            history.update({h[0]: h for h in _histories(b)})
        first, last = min(epochs), max(epochs)
        if len(epochs) != last - first + 1 or any(len(v) != k * (d + 1) for v in epochs.values()):
            raise ValueError("only models of one shape and of consecutive epochs can be packed")
        flat = np.concatenate([epochs[e] for e in range(first, last + 1)])
        if flat.size > MAX_MODEL_CELLS:
            raise ValueError("too many models to pack on the driver")
        body = {"k": k, "d": d, "file": self._pack(self.spark.createDataFrame(_table(flat, k, d, first)).repartition(1))}
        self._commit(first, last, body, found, [history[e] for e in sorted(history)] or None)
        for r, _ in inline:
            self.log.remove(r[3])
        return len(inline)

    # ---- reading ---------------------------------------------------------
    def latest(self) -> DataFrame:
        last = self.last_epoch()
        if last is None:
            raise ValueError(f"no model stored under {self.path}")
        return self.read_epoch(last)

    def _record_of(self, epoch: int) -> tuple[int, dict]:
        for _, first, last, name in reversed(self.records()):
            if first <= epoch <= last:
                return first, json.loads(self.log.read(name))
        raise ValueError(f"epoch {epoch} is not stored under {self.path}")

    def read_epoch(self, epoch: int) -> DataFrame:
        first, record = self._record_of(int(epoch))
        if "file" in record:
            packed = self.spark.read.schema(_TABLE).parquet(f"{self.path}/{record['file']}")
            return packed.filter(F.col("epoch") == F.lit(int(epoch)))
        cells = record["k"] * (record["d"] + 1)
        flat = _weights(record)[(int(epoch) - first) * cells:][:cells]
        return self.spark.createDataFrame(_table(flat, record["k"], record["d"], int(epoch)))

    def read_model(self, epoch: int) -> LinearModel:
        """The model of an epoch as a value (no Spark job while it is in its record)."""
        first, record = self._record_of(int(epoch))
        if "file" in record:
            return LinearModel.from_table(self.read_epoch(epoch))
        cells = record["k"] * (record["d"] + 1)
        return LinearModel.from_flat(_weights(record)[(int(epoch) - first) * cells:][:cells], record["k"], record["d"])

    def histories(self) -> list[tuple]:
        """The history rows of all epochs that have one, in epoch order; all records in one Spark read."""
        if not self.records():
            return []
        # the rows are of mixed types, so they come as text
        raw = self.spark.read.schema("history string").json(f"{self.path}/log/*.json").where("history is not null").collect()
        return [tuple(v) for _, v in sorted({h[0]: h for r in raw for h in _histories({"history": json.loads(r[0])})}.items())]


def _weights(record: dict) -> np.ndarray:
    return np.frombuffer(base64.b64decode(record["weights"]), dtype="<f8")


def _histories(record: dict) -> list[list]:
    """One row, or of a packed record a list of rows."""
    h = record.get("history")
    return [] if not h else h if isinstance(h[0], list) else [h]


def _table(flat: np.ndarray, k: int, d: int, first: int) -> pa.Table:
    """Stacked models as ``class_idx, feature_idx, weight, epoch``."""
    cells = k * (d + 1)
    n = flat.size // cells
    return pa.table({"class_idx": pa.array(np.tile(np.repeat(np.arange(k), d + 1), n), pa.int32()),
                     "feature_idx": pa.array(np.tile(np.arange(d + 1), n * k), pa.int32()),
                     "weight": pa.array(flat.astype(np.float64)),
                     "epoch": pa.array(np.repeat(np.arange(first, first + n), cells), pa.int32())})
