"""Centroid clustering with ns-bounds: k-means whose stored bounds are loosened by whole displacements.

Each vector keeps its centroid, an upper bound on the distance to it and a lower bound for every centroid, each with the
round in which it was measured.  The centroids of all rounds are kept (rounds x k x d numbers, broadcast).  A bound of round s
holds in round t after moving it by the norm of the centroid's total displacement between s and t, which is
never more than the sum of the single rounds' drifts (Newling and Fleuret 2016).  Where the loosened upper
bound lies under all lower bounds the vector keeps its centroid unread; else the distance to its own
centroid is measured again, and then those to the centroids whose lower bounds still do not clear it.  Measured distances are whole
numbers, bounds carry a margin for rounding, and ties go to the smaller number, so the
result is that of comparing all distances.

Spark: a round is one scan of the stored states (vector, centroid, bounds) that writes the next ones, and one aggregate of exact
sums by centroid (k x (d + 1) numbers a task); the driver holds centroids only.  Lost tasks are run again from the stored table.

Defined cases: vectors that are null, hold null, NaN or infinite entries or have another length than ``dimension`` give no
rows; null ids hash as ``null``; start vectors whose hashes tie (repeated ids) are ordered by their entries; repeated
rows count each time; with fewer than ``k`` vectors there are as many centroids as vectors; a centroid without
vectors stays; an empty table gives no rows; other columns are not read; longer vectors are not kept, entries from 2^34 on end in an error.
"""

from __future__ import annotations

import decimal
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.common import Shared
from ridgeway.llm.graph import store
from ridgeway.llm.vectors import finite, listed, matrix, whole

CLUSTERS, DIMENSION, FACTOR, ROUNDS, SEED = 16, 64, 64, 3, 1
_MARGIN = 1e-9


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows to one centroid (Python's integers where 64 bits are not enough)."""
    y = x - centroid
    top = int(np.abs(y).max(initial=0))
    if top * top * max(1, x.shape[1]) >= 2 ** 63:
        y = y.astype(object)
    return (y * y).sum(axis=1)


class Bounds:
    """States of a batch: centroid, distance bounds, and the rounds they are from."""

    def __init__(self, history: np.ndarray):
        self.history, self.now = history, len(history) - 1       # (rounds, k, d)
        moved = (history - history[-1]).astype(np.float64)
        # norm of the whole displacement of each centroid since each round, rounded up
        self.drift = np.sqrt((moved * moved).sum(axis=2)) * (1 + _MARGIN)
        self.k = history.shape[1]
        self.measured = 0

    def first(self, x: np.ndarray):
        """States where every distance is measured."""
        n = len(x)
        d2 = np.stack([squared(x, c) for c in self.history[-1]], axis=1)
        self.measured += n * self.k
        own = np.argmin(d2, axis=1).astype(np.int32)
        lower = np.sqrt(d2.astype(np.float64))
        return own, lower, np.full((n, self.k), self.now, dtype=np.int16)

    def update(self, x: np.ndarray, own: np.ndarray, lower: np.ndarray, since: np.ndarray):
        """States of this round.  ``lower`` holds distances as measured in round ``since``: for the own centroid it
        bounds from above (plus its drift), for the others from below (minus theirs)."""
        own, lower, since = own.copy(), lower.copy(), since.copy()
        rows, here = np.arange(len(x)), self.history[-1]
        upper = lower[rows, own] + self.drift[since[rows, own], own]
        under = lower - self.drift[since, np.arange(self.k)]
        slack = _MARGIN * (1 + upper)
        under[rows, own] = np.inf
        unsure = rows[under.min(axis=1) <= upper + slack]
        if not len(unsure):
            return own, lower, since
        # the own distance again, exactly
        best = np.zeros(len(unsure), dtype=object)
        for c in np.unique(own[unsure]):
            at = np.flatnonzero(own[unsure] == c)
            best[at] = squared(x[unsure[at]], here[c])
        self.measured += len(unsure)
        near = np.sqrt(best.astype(np.float64))
        lower[unsure, own[unsure]], since[unsure, own[unsure]] = near, self.now
        # then the centroids whose bounds do not clear it
        open_ = under[unsure] <= (near * (1 + _MARGIN) + _MARGIN)[:, None]
        to = own[unsure].copy()
        for c in range(self.k):
            at = np.flatnonzero(open_[:, c])
            if not len(at):
                continue
            d2 = squared(x[unsure[at]], here[c])
            self.measured += len(at)
            lower[unsure[at], c], since[unsure[at], c] = np.sqrt(d2.astype(np.float64)), self.now
            better = (d2 < best[at]) | ((d2 == best[at]) & (c < to[at]))
            best[at[better]], to[at[better]] = d2[better], c
        own[unsure] = to
        return own, lower, since


def whole_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dimension: int = DIMENSION, factor: int = FACTOR) -> DataFrame:
    """(id, x) of the kept rows."""
    kept = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    return kept.where((F.size("v") == dimension) & finite(F.col("v"))).select("id", whole(F.col("v"), factor).alias("x"))


def start(vectors: DataFrame, k: int, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest hashes, in their order (k rows reach the driver)."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    rows = vectors.select(F.sha2(told.cast("binary"), 256).alias("hash"), "x").orderBy("hash", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], dtype=np.int64)


def _assign(shared, d: int, first: bool):
    def run(batches):
        bounds = Bounds(shared.value)
        for batch in batches:
            x = matrix(batch.column("x"), d)
            if first:
                own, lower, since = bounds.first(x)
            else:
                own, lower, since = bounds.update(x, batch.column("cluster").to_numpy(), matrix(batch.column("lower"), bounds.k), matrix(batch.column("since"), bounds.k))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), pa.array(own, pa.int32()), listed(lower), listed(since)],
                                             names=["id", "x", "cluster", "lower", "since"])
    return run


def _sums(d: int, k: int):
    """Per task: count and exact entry sums of each centroid's vectors."""
    def run(batches):
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, d), dtype=object)
        for batch in batches:
            x, own = matrix(batch.column("x"), d), batch.column("cluster").to_numpy()
            for c in np.unique(own):
                at = own == c
                counts[c] += int(at.sum())
                sums[c] += x[at].sum(axis=0, dtype=np.int64).astype(object)   # at most 2^40 times the rows of a batch
        at = np.flatnonzero(counts)
        cells = np.repeat(at, d + 1) * (d + 1) + np.tile(np.arange(d + 1), len(at))
        values = [v for c in at for v in (counts[c], *sums[c])]
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array([decimal.Decimal(int(v)) for v in values], pa.decimal128(38, 0))], names=["cell", "value"])
    return run


def moved(states: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid as the floor of the mean of its vectors; one without vectors stays."""
    k, d = centroids.shape
    rows = states.select("x", "cluster").mapInArrow(_sums(d, k), "cell long, value decimal(38,0)").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    got = {r["cell"]: int(r["value"]) for r in rows}
    out = centroids.copy()
    for c in range(k):
        n = got.get(c * (d + 1), 0)
        if n:
            out[c] = [got[c * (d + 1) + 1 + j] // n for j in range(d)]
    return out


def _distances(shared, d: int):
    def run(batches):
        here = shared.value
        for batch in batches:
            x, own = matrix(batch.column("x"), d), batch.column("cluster").to_numpy()
            far = np.zeros(len(x), dtype=object)
            for c in np.unique(own):
                far[own == c] = squared(x[own == c], here[c])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("cluster"), pa.array(far.tolist(), pa.int64())], names=["id", "cluster", "distance"])
    return run


def cluster(vectors: DataFrame, *, k: int = CLUSTERS, rounds: int = ROUNDS, dimension: int = DIMENSION, factor: int = FACTOR, seed: int = SEED,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per kept row: id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    x = whole_vectors(vectors, id_col=id_col, vector_col=vector_col, dimension=dimension, factor=factor)
    id_type = x.schema["id"].dataType.simpleString()
    centroids = start(x, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], f"`{id_col}` {id_type}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    state = f"id {id_type}, x array<long>, cluster int, lower array<double>, since array<smallint>"
    history, states = [centroids], None
    for t in range(rounds + 1):
        shared = Shared(spark, np.stack(history))
        states = store((x if states is None else states).mapInArrow(_assign(shared, dimension, states is None), state), f"bounds_{t}")
        if t < rounds:
            history.append(moved(states, history[-1]))
    last = history[-1]
    found = store(states.select("id", "cluster", "x").mapInArrow(_distances(Shared(spark, last), dimension), f"id {id_type}, cluster int, distance long"), "clusters")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}   # k rows
    shas = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in last]
    of = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1)
    return found.select(F.col("id").alias(id_col), "cluster", "distance", of([sums.get(c, 0) for c in range(len(last))], "long").alias("cluster_inertia"),
                        F.lit(sum(sums.values())).cast("long").alias("inertia"), of(shas, "string").alias("centroid_sha256"))
