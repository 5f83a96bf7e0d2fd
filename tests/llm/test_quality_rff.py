from __future__ import annotations

import numpy as np
import pandas as pd

from ridgeway.llm import queries as Q
from ridgeway.llm import quality_rff as R

from tests.llm.helpers import SF, rows


def test_held_out_accuracy(spark):
    got = Q.QUERIES["op1_rff_quality"](spark, SF).toPandas()
    truth = pd.read_parquet(f"{SF}/labels.parquet")
    held = got[got.held_out].merge(truth, on="doc_id")
    assert len(got) == 1000 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert (held.predicted == held.quality).mean() > 0.93
    assert (held[held.quality == 1].predicted == 1).mean() > 0.97


def test_isotonic_matches_brute_force():
    rng = np.random.default_rng(0)
    x, y, w = np.arange(40.0), rng.random(40), rng.integers(1, 5, 40).astype(float)
    px, py = R.isotonic(x, y, w)
    assert (np.diff(py) > 0).all()
    # min-max formula of weighted isotonic regression
    avg = lambda a, b: np.average(y[a:b + 1], weights=w[a:b + 1])
    want = [max(min(avg(a, b) for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert np.allclose(sorted(set(np.round(want, 9))), np.round(py, 9))


def test_kernel_approximates_the_gaussian():
    rng = np.random.default_rng(1)
    k = R.Kernel(np.zeros(3), np.ones(3), dimension=20_000, width=1.0)
    x = rng.standard_normal((5, 3)) / 2
    z = k.map(x)[:, :-1]
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * 3))
    assert np.abs(z @ z.T - want).max() < 0.03


def test_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (5, None), (7, 0), (8, 1), (None, 1), (99, 1)], "doc_id long, quality int")
    f = R.featurise(edge_docs)
    got = R.score(f, R.fit(f, labels))
    assert got.count() == 11 and got.where("score is null or isnan(score) or score < 0 or score > 1").count() == 0
    assert rows(got.where("doc_id is null"), "held_out") == [(True,)]
    none = R.score(f, R.fit(f, labels.limit(0)))
    assert {r.score for r in none.collect()} == {0.5}
    e = R.featurise(empty_docs)
    assert R.score(e, R.fit(e, labels)).count() == 0
    assert R.statistics(b"").tolist() == [0.0] * len(R.FEATURES)
