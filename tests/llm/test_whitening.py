from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeway.llm import whitening as W

from tests.llm.helpers import SF


@pytest.mark.parametrize("d", [1, 2, 3, 8, 64, 100])
def test_eigen_against_numpy(d):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    spectra = [rng.standard_normal(d), np.ones(d), np.zeros(d), np.r_[np.full(d // 2, 5.0), np.ones(d - d // 2)], np.exp(-np.arange(d)),
               np.r_[1.0, np.zeros(d - 1)], 1 + 1e-12 * np.arange(d), 10.0 ** -np.linspace(0, 14, d)]
    for s in spectra:
        a = (q * s) @ q.T
        a = (a + a.T) / 2
        e, v = W.eigen(a)
        size = max(np.linalg.norm(a), 1e-300)
        assert np.abs(v.T @ v - np.eye(d)).max() < 1e-13
        assert np.linalg.norm(a @ v - v * e) < 1e-13 * size
        assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * size and (np.diff(e) <= 0).all()


def test_polar_factor():
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    s = np.concatenate([np.linspace(0.2, 1, 20), -10.0 ** -np.linspace(0, 12, 20)])
    u = W.polar((q * s) @ q.T, 1e-13)
    assert np.abs(u - (q * np.sign(s)) @ q.T).max() < 1e-3 and np.abs(u @ u - np.eye(40)).max() < 1e-12
    mild = W.polar((q * np.sign(s) * np.linspace(0.1, 1, 40)) @ q.T, 0.05)
    assert np.abs(mild - (q * np.sign(s)) @ q.T).max() < 1e-13


def brute(vectors, components=4):
    """vectors: (id, list) of one length -> id, component -> (n, deviation, |whitened|, explained)."""
    x = np.array([np.floor(np.array(v) * 256) for _, v in vectors]).astype(int)
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    y = u - s / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(components, int((e > 1e-12 * e[0]).sum()))
    w = (x - s / n) @ v[:, :k] / np.sqrt(e[:k])
    out = [(i, c + 1, n, sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)), abs(float(w[r, c])), e[c] / e.sum())
           for r, ((i, _), row) in enumerate(zip(vectors, x)) for c in range(k)]
    return sorted(out, key=lambda t: (str(t[0]), t[1], t[4]))


def check(got, want):
    got = sorted(((r["vec_id"], r["component"], r["n"], int(r["deviation"]), abs(r["whitened"]), r["explained"]) for r in got), key=lambda t: (str(t[0]), t[1], t[4]))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-8, abs=1e-9)


def test_query_rows_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = W.whiten(table).collect()
    check(got, brute([(r["vec_id"], r["embedding"]) for r in table.collect()]))
    assert all(0 <= r["identity_error"] < 1e-10 for r in got)
    one = {}
    for r in got:   # either sign, but the same for all rows: whitened values are uncorrelated with unit variance
        one.setdefault(r["component"], []).append(r["whitened"])
    assert np.abs(np.cov(np.array([one[c] for c in sorted(one)]), ddof=0) - np.eye(4)).max() < 1e-9
    again = {(r["vec_id"], r["component"]): r["whitened"] for r in W.whiten(table.repartition(7)).collect()}
    # the model is the same to the bit for any partitioning; products of a batch may differ in the last one
    assert all(again[r["vec_id"], r["component"]] == pytest.approx(r["whitened"], abs=1e-13) for r in got)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, (rng.standard_normal(3) * 1e6 + 1e8).round(3).tolist()) for i in range(60)]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    check(W.whiten(table).collect(), brute(vectors))


def test_edges(spark):
    rng = np.random.default_rng(4)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(9)]
    good += [(8, good[8][1]), (None, good[0][1]), (20, [-0.0] * 5)]
    bad = [(30, None), (31, [1.0, None, 0.0, 0.0, 0.0]), (32, [float("nan")] * 5), (33, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (34, [1.0, 2.0]), (35, [])]
    schema = "vec_id long, embedding array<double>"
    table = spark.createDataFrame(good + bad, schema).select("*", *[F.lit("own").alias(c) for c in ("id", "x", "v", "d", "n", "cell", "value", "component")])
    check(W.whiten(table).collect(), brute(good))
    assert W.whiten(table.limit(0)).collect() == []
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)
    assert W.whiten(flat).collect() == []                      # one distinct vector: no variance
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(6)], schema)
    assert {r["component"] for r in W.whiten(line).collect()} == {1}   # a line has one component
    with pytest.raises(Exception, match="too large"):
        W.whiten(spark.createDataFrame([(1, [1e30]), (2, [0.0])], schema)).collect()
