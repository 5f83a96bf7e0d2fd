from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeway.llm import ns_kmeans as K

from tests.llm.helpers import SF


def brute(vectors, k=16, rounds=3, d=64, factor=64):
    kept = [(i, [int(np.floor(float(c) * factor)) for c in v]) for i, v in vectors
            if v is not None and len(v) == d and all(c is not None and np.isfinite(c) for c in v)]
    start = sorted((hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest(), x) for i, x in kept)[:k]
    centroids = [x for _, x in start]
    for t in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids] for _, x in kept]
        own = [min(range(len(centroids)), key=lambda c: (f[c], c)) for f in far]
        if t < rounds:
            for c in range(len(centroids)):
                mine = [x for (_, x), o in zip(kept, own) if o == c]
                if mine:
                    centroids[c] = [sum(col) // len(mine) for col in zip(*mine)]
    near = [f[o] for f, o in zip(far, own)]
    inertia = [sum(n for n, o in zip(near, own) if o == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, o, n, inertia[o], sum(inertia), sha[o]) for (i, _), o, n in zip(kept, own, near)), key=str)


def run(table, **how):
    return sorted((tuple(r) for r in K.cluster(table, **how).collect()), key=str)


def test_against_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    plain = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert run(table) == run(table.repartition(5)) == brute(plain)


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_and_save_distances(seed):
    """Every stored bound is a bound, ties included, and clustered data is mostly left unread."""
    rng = np.random.default_rng(seed)
    k, d, n = 12, 4, 600
    spread = 3 if seed % 2 else 400
    x = (rng.integers(-spread, spread, (k, d))[rng.integers(0, k, n)] + rng.integers(-2, 3, (n, d))).astype(np.int64)
    history, state, read = [x[:k].copy()], None, 0
    for t in range(6):
        bounds = K.Bounds(np.stack(history))
        state = bounds.first(x) if state is None else bounds.update(x, *state)
        read += bounds.measured if t else 0
        own, lower, since = state
        d2 = ((x[:, None, :] - history[-1][None]) ** 2).sum(axis=2)
        assert (own == d2.argmin(axis=1)).all()
        true = np.sqrt(d2)
        drift = np.stack([np.linalg.norm(history[-1] - h, axis=1) for h in history])
        moved = drift[since, np.arange(k)]
        others = np.arange(k)[None] != own[:, None]
        assert (lower - moved <= true + 1e-9)[others].all()
        at = np.arange(n)
        assert (lower[at, own] + moved[at, own] >= true[at, own] - 1e-9).all()
        history.append(np.stack([x[own == c].sum(axis=0) // max(1, (own == c).sum()) if (own == c).any() else history[-1][c] for c in range(k)]))
    assert read < 5 * n * k * (0.5 if spread > 3 else 1)


def test_whole_displacement_is_tighter_than_summed_drifts():
    back = np.stack([np.zeros((1, 2), dtype=np.int64), np.full((1, 2), 50), np.zeros((1, 2), dtype=np.int64)])
    assert K.Bounds(back).drift[0, 0] == 0   # there and back: no loosening, where summed drifts give 141


def test_huge_whole_numbers():
    x = np.array([[2 ** 39, -2 ** 39], [0, 1]], dtype=np.int64)
    assert K.squared(x, np.array([-2 ** 39, 2 ** 39]))[0] == 2 * (2 ** 40) ** 2


def test_edges(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.standard_normal(3).tolist()) for i in range(40)]
    good += [(7, good[7][1]), (7, good[8][1]), (None, good[0][1]), (None, None)]
    bad = [(50, None), (51, [1.0, None, 2.0]), (52, [1.0, float("nan"), 2.0]), (53, [1.0, float("-inf"), 2.0]), (54, [1.0, 2.0]), (55, [1.0] * 4), (56, [])]
    schema = "vec_id long, embedding array<double>"
    table = spark.createDataFrame(good + bad, schema).select("*", *[F.lit("own").alias(c) for c in ("id", "x", "v", "cluster", "lower", "since", "distance")])
    assert run(table, k=5, dimension=3) == brute(good + bad, k=5, d=3)
    assert run(table.where("vec_id < 3"), k=5, dimension=3) == brute([g for g in good if g[0] is not None and g[0] < 3], k=5, d=3)
    assert run(table.limit(0), k=5, dimension=3) == []
    same = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(30)], schema)
    assert {(r[1], r[2]) for r in run(same, k=4, dimension=2)} == {(0, 0)}
