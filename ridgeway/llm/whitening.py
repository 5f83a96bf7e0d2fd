"""Embedding whitening by QDWH spectral divide-and-conquer.

Vectors become whole numbers (floor(256 c)).  The model is fitted on the distinct vectors: one pass counts
them and adds them up, a second adds the products of their differences from the rounded mean, all as exact integers, so
the covariance (centred, divisor n) is rounded once, whatever the partitions.  Only d + 1 and
d (d + 1) / 2 numbers reach the driver, with d at most ``MAX_DIMENSION``.

Its eigenvectors come from polar decompositions.  The unitary factor U of A - s I, by QR-based dynamically weighted
Halley (QDWH) iterations, is the matrix sign: (U + I) / 2 projects on the eigenvectors above the shift s.
Its range and its complement split the space in two, A is projected on each, and both parts are split again
until they are a single number or a multiple of the identity (Nakatsukasa and Higham 2013).
The components are broadcast and each vector is projected in one scan.

Defined cases: null vectors, and vectors with a null, NaN or infinite entry, give no rows; where lengths differ, the
length that most remaining rows have counts (the longer of a tie) and rows of another length give none; repeated rows
and vectors are whitened one by one and fitted once; null ids are kept; components
whose variance is 0 to rounding (below d * 1e-14 of the largest) can't be whitened and are left out, so one distinct vector gives no
rows, and neither does an empty table; equal eigenvalues give some orthonormal basis of their space; other columns are not read;
very long vectors are refused with ``MAX_DIMENSION``, entries from 2^32 on with an error.
"""

from __future__ import annotations

import decimal
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.llm.graph import store
from ridgeway.llm.vectors import CELLS, cells, finite, listed, matrix, product, total, whole

FACTOR, COMPONENTS, MAX_DIMENSION = 256, 4, 4096
_EPS = np.finfo(float).eps


# ---- spectral divide and conquer on the driver (d x d numbers) ------------------------------

def polar(a: np.ndarray, least: float, rounds: int = 40) -> np.ndarray:
    """The unitary polar factor of a symmetric ``a`` with singular values in [least, 1] (about)."""
    d, x, low = len(a), a.copy(), max(least, 1e-18)
    one = np.eye(d)
    for _ in range(rounds):
        # weights of the Halley step that lift the smallest singular value fastest
        g = np.cbrt(4 * (1 - low * low) / low ** 4)
        root = np.sqrt(1 + g)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * g + 8 * (2 - low * low) / (low * low * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:   # QR form: stable while x is ill-conditioned
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, one]))
            step = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * q[:d] @ q[d:].T
        else:          # Cholesky form
            z = np.linalg.cholesky(one + wc * x.T @ x)
            step = (wb / wc) * x + (wa - wb / wc) * np.linalg.solve(z.T, np.linalg.solve(z, x.T)).T
        low = min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        moved = np.linalg.norm(step - x)
        x = (step + step.T) / 2
        if moved < 1e-8 * np.sqrt(d) and abs(1 - low) < 1e-8:   # cubic: the next error is below rounding
            break
    return x


def _ranges(projector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range (k columns) and of the null space of a projector."""
    order = np.argsort(-np.diag(projector), kind="stable")
    q, _ = np.linalg.qr(projector[:, order[:k]])
    for _ in range(2):   # subspace iteration: the projector's eigenvalues are 1 and 0, so it ends at once
        q, _ = np.linalg.qr(projector @ q)
    rest = np.eye(len(projector)) - q @ q.T
    order = np.argsort(-np.diag(rest), kind="stable")
    p, _ = np.linalg.qr(rest[:, order[: len(rest) - k]])
    for _ in range(2):
        p, _ = np.linalg.qr(p - q @ (q.T @ p))
    return q, p


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of two complementary invariant subspaces of a symmetric matrix, the upper eigenvalues first."""
    d = len(a)
    diagonal = np.sort(np.diag(a))
    size = np.linalg.norm(a)
    mean = np.trace(a) / d
    middles = (diagonal[1:] + diagonal[:-1]) / 2
    # the widest gaps of the diagonal near its middle, then the mean, then around it
    gaps = np.argsort(-(diagonal[1:] - diagonal[:-1]) * (1 + np.minimum(np.arange(1, d), d - np.arange(1, d))), kind="stable")
    spread = np.linalg.norm(a - mean * np.eye(d)) / np.sqrt(d)
    shifts = [middles[gaps[0]], mean, np.median(diagonal), *(mean + spread * t for t in (0.5, -0.5, 0.25, -0.25, 1.0, -1.0, 0.1, -0.1))]
    for shift in shifts:
        moved = a - shift * np.eye(d)
        high = np.linalg.norm(moved)
        if high == 0:
            continue
        x = moved / high
        inverse = 1 / max(np.linalg.cond(x, 1), 1.0) / np.sqrt(d)
        if inverse < _EPS:   # the shift is an eigenvalue: no sign there
            continue
        u = polar(x, inverse)
        k = int(round((np.trace(u) + d) / 2))
        if not 0 < k < d:
            continue
        q, p = _ranges((u + np.eye(d)) / 2, k)
        if np.linalg.norm(p.T @ a @ q) <= 64 * d * _EPS * size:
            return q, p
    return None


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix."""
    d = len(a)
    scale = np.linalg.norm(a)

    def parts(m: np.ndarray, basis: np.ndarray):
        n = len(m)
        off = np.linalg.norm(m - np.diag(np.diag(m)))
        if n == 1 or off <= 4 * n * _EPS * scale:   # diagonal: done
            yield from ((m[k, k], basis[:, k]) for k in range(n))
            return
        both = _split(m)
        if both is None:   # no shift separates it: turn the plane of the largest entry off the diagonal
            both = _turn(m)
        if isinstance(both, np.ndarray):
            m = both.T @ m @ both
            yield from parts((m + m.T) / 2, basis @ both)
            return
        for v in both:
            part = v.T @ m @ v
            yield from parts((part + part.T) / 2, basis @ v)

    found = sorted(parts((a + a.T) / 2, np.eye(d)), key=lambda p: -p[0])
    return np.array([e for e, _ in found]), np.array([v for _, v in found]).T.reshape(d, d)


def _turn(m: np.ndarray) -> np.ndarray:
    off = np.abs(m - np.diag(np.diag(m)))
    i, j = np.unravel_index(np.argmax(off), off.shape)
    angle = 0.5 * np.arctan2(2 * m[i, j], m[i, i] - m[j, j])
    out = np.eye(len(m))
    out[i, i] = out[j, j] = np.cos(angle)
    out[j, i], out[i, j] = np.sin(angle), -np.sin(angle)
    return out


# ---- the model ------------------------------------------------------------------------------

@dataclass
class Whitener:
    """``rows`` (components x d) projects x - S / n to whitened values."""
    n: int
    sums: list[int]
    eigenvalues: np.ndarray
    rows: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def _parts(self) -> tuple[np.ndarray, np.ndarray]:
        base = [s // self.n for s in self.sums]
        return np.array(base, dtype=np.int64), np.array([(s - b * self.n) / self.n for s, b in zip(self.sums, base)])

    def project(self, x: np.ndarray) -> np.ndarray:
        base, rest = self._parts()   # whole numbers first: the small difference keeps all its digits
        return ((x - base).astype(np.float64) - rest) @ self.rows.T

    def deviation(self, x: np.ndarray) -> list[int]:
        """sum over dimensions of (n x - S)^2, exact."""
        low, high = int(x.min(initial=0)), int(x.max(initial=0))
        top = max(max(abs(self.n * low - s), abs(self.n * high - s)) for s in self.sums) if self.sums else 0
        if top * top * max(1, len(self.sums)) < 2 ** 63:
            y = self.n * x - np.array(self.sums, dtype=np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * x.astype(object) - np.array(self.sums, dtype=object)
        return (y * y).sum(axis=1).tolist()


def whole_vectors(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", factor: int = FACTOR) -> tuple[DataFrame, int]:
    """(id, x) of the remaining rows, and their length."""
    vector = F.col(f"`{vector_col}`")
    kept = vectors.select(F.col(f"`{id_col}`").alias("id"), vector.alias("v")).where(finite(F.col("v")))
    lengths = kept.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    if d > MAX_DIMENSION:
        raise ValueError(f"vectors have {d} entries, at most {MAX_DIMENSION} can be whitened")
    return kept.where(F.size("v") == d).select("id", whole(F.col("v"), factor).alias("x")), d


def _products(d: int, base: list[int]):
    """Per task: sums of z and of the upper triangle of z z', with z = x - base."""
    upper = np.triu_indices(d)

    def run(batches):
        one, two = np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
        shift = np.array(base, dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                z = matrix(batch.column("x").slice(lo, 4096), d) - shift
                one += z.astype(object).sum(axis=0)
                two += product(z, z)
        yield cells([*one, *two[upper]])
    return run


def _sums(d: int):
    def run(batches):
        n, s = 0, np.zeros(d, dtype=object)
        for batch in batches:
            x = matrix(batch.column("x"), d)
            n += len(x)
            s += x.astype(object).sum(axis=0)
        yield cells([n, *s])
    return run


def covariance(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[Fraction]]]:
    """n, the sums, and the covariance of the rows of ``fit`` (x), exact."""
    n, *sums = total(fit.mapInArrow(_sums(d), CELLS), d + 1)
    if not n:
        return 0, sums, []
    base = [s // n for s in sums]
    got = total(fit.mapInArrow(_products(d, base), CELLS), d + d * (d + 1) // 2)
    one, two = got[:d], iter(got[d:])
    v = [[Fraction(0)] * d for _ in range(d)]
    for i in range(d):
        for j in range(i, d):
            v[i][j] = v[j][i] = Fraction(n * next(two) - one[i] * one[j], n * n)
    return n, sums, v


def fit(vectors: DataFrame, d: int, *, components: int = COMPONENTS) -> Whitener | None:
    """Learns from the distinct vectors of (id, x); None where nothing can be whitened."""
    if not d:
        return None
    distinct = store(vectors.select("x").distinct(), "distinct")
    n, sums, v = covariance(distinct, d)
    if not n:
        return None
    trace = sum(v[i][i] for i in range(d))
    if not trace:
        return None
    values, basis = eigen(np.array([[float(c) for c in row] for row in v]))
    k = min(components, int((values > d * 1e-14 * values[0]).sum()))
    rows = basis[:, :k].T / np.sqrt(values[:k])[:, None]
    model = Whitener(n, sums, values[:k], rows, values[:k] / float(trace))
    model.identity_error = identity_error(distinct, model, d)
    return model


def identity_error(distinct: DataFrame, model: Whitener, d: int) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, measured on them."""
    k = len(model.rows)

    def run(batches):
        one, two = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.project(matrix(batch.column("x"), d))
            one += w.sum(axis=0)
            two += w.T @ w
        values = np.concatenate([one, two.reshape(-1)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["cell", "value"])

    rows = distinct.mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    got = np.zeros(k + k * k)
    for r in rows:
        got[r["cell"]] = r["value"]
    mean = got[:k] / model.n   # the vectors are centred already: this only takes rounding off
    return float(np.abs(got[k:].reshape(k, k) / model.n - np.outer(mean, mean) - np.eye(k)).max())


WHITENED = "deviation decimal(38,0), whitened array<double>"


def transform(vectors: DataFrame, model: Whitener | None, d: int) -> DataFrame:
    """Per row of (id, x): id, deviation (exact), whitened (one value a component)."""
    schema = f"id {vectors.schema['id'].dataType.simpleString()}, {WHITENED}"
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = matrix(part.column("x"), d)
                far = pa.array([decimal.Decimal(v) for v in model.deviation(x)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([part.column("id"), far, listed(model.project(x))], names=["id", "deviation", "whitened"])

    return vectors.mapInArrow(run, schema)


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, factor: int = FACTOR) -> DataFrame:
    """Per remaining row and component: id, component, n, deviation (decimal), whitened, explained, identity_error."""
    x, d = whole_vectors(vectors, id_col=id_col, vector_col=vector_col, factor=factor)
    model = fit(x, d, components=components)
    out = transform(x, model, d).select("id", "deviation", F.posexplode("whitened").alias("at", "value"))
    explained = F.array(*[F.lit(float(v)) for v in (model.explained if model else [0.0])])
    return out.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
                      "deviation", F.col("value").alias("whitened"), F.element_at(explained, F.col("at") + 1).alias("explained"),
                      F.lit(model.identity_error if model else 0.0).alias("identity_error"))
