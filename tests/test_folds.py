"""Per-row update rules against plain numpy written straight from the rules."""

from __future__ import annotations

import numpy as np
import pytest

from ridgeway.operators.folds import FOLDS, Lockstep, ShardState, fold_hinge, fold_multiclass_hinge, fold_softmax

rng = np.random.default_rng(7)


def ref_hinge(X, y, alpha, l2, w, b):
    w = w.copy()
    for i in range(len(y)):
        if y[i] * (np.dot(X[i], w) + b) < 1:
            w -= alpha * (w * l2 - y[i] * X[i])
            b -= alpha * (-y[i])
        else:
            w -= alpha * (w * l2)
    return w, b


def ref_multi(X, y, alpha, l2, W, b):
    W, b = W.copy(), b.copy()
    for i in range(len(y)):
        s = W @ X[i] + b
        m = s - s[y[i]] + 1.0
        m[y[i]] = 0
        g = np.zeros(len(b))
        g[m > 0] = 1
        g[y[i]] = -np.sum(m > 0)
        W -= alpha * (np.outer(g, X[i]) + l2 * W)
        b -= alpha * g
    return W, b


def ref_softmax(X, y, alpha, W, b):
    W, b = W.copy(), b.copy()
    for i in range(len(y)):
        e = np.exp(W @ X[i] + b)
        p = e / e.sum()
        oh = np.zeros(len(b))
        oh[y[i]] = 1
        W += alpha * np.outer(oh - p, X[i])
        b += alpha * (oh - p)
    return W, b


def test_hinge_matches_rule():
    X = rng.normal(size=(200, 3))
    y = np.where(rng.random(200) > 0.5, 1.0, -1.0)
    st = ShardState(np.zeros((1, 3)), np.zeros(1))
    fold_hinge(st, X, y, 0.01, 1.0, True)
    w, b = ref_hinge(X, y, 0.01, 1.0, np.zeros(3), 0.0)
    np.testing.assert_allclose(st.coef[0], w, rtol=1e-12, atol=1e-14)
    assert st.intercept[0] == pytest.approx(b, abs=1e-14)
    assert st.n_rows == 200


def test_exact_margin_is_not_a_violation():
    st = ShardState(np.array([[1.0]]), np.array([0.0]))
    fold_hinge(st, np.array([[1.0]]), np.array([1.0]), 0.5, 0.0, True)  # y*z == 1
    assert st.coef[0, 0] == 1.0 and st.intercept[0] == 0.0
    assert st.loss_sum == 0.0


def test_multiclass_hinge_matches_rule():
    X = rng.normal(size=(150, 5))
    y = rng.integers(0, 4, size=150)
    st = ShardState(np.zeros((4, 5)), np.zeros(4))
    fold_multiclass_hinge(st, X, y.astype(float), 0.01, 1e-4, True)
    W, b = ref_multi(X, y, 0.01, 1e-4, np.zeros((4, 5)), np.zeros(4))
    np.testing.assert_allclose(st.coef, W, rtol=1e-10, atol=1e-12)
    np.testing.assert_allclose(st.intercept, b, rtol=1e-10, atol=1e-12)


def test_softmax_matches_rule_and_survives_saturation():
    X = rng.normal(size=(150, 5))
    y = rng.integers(0, 3, size=150)
    st = ShardState(np.zeros((3, 5)), np.zeros(3))
    fold_softmax(st, X, y.astype(float), 0.05, 0.0, True)
    W, b = ref_softmax(X, y, 0.05, np.zeros((3, 5)), np.zeros(3))
    np.testing.assert_allclose(st.coef, W, rtol=1e-9, atol=1e-12)
    big = ShardState(np.full((3, 1), 900.0), np.zeros(3))
    big.coef[1, 0] = -900.0
    fold_softmax(big, np.array([[1.0]]), np.array([1.0]), 0.05, 0.0, True)
    assert np.isfinite(big.coef).all() and np.isfinite(big.loss_sum)


def test_no_intercept_keeps_it_zero():
    st = ShardState(np.zeros((1, 2)), np.zeros(1))
    fold_hinge(st, rng.normal(size=(20, 2)), np.ones(20), 0.1, 0.0, False)
    assert st.intercept[0] == 0.0


def test_one_class_shard_matches_rule():
    X = rng.normal(size=(60, 4))
    y = np.full(60, 2)
    st = ShardState(np.zeros((3, 4)), np.zeros(3))
    fold_multiclass_hinge(st, X, y.astype(float), 0.01, 1e-4, True)
    W, b = ref_multi(X, y, 0.01, 1e-4, np.zeros((3, 4)), np.zeros(3))
    np.testing.assert_allclose(st.coef, W, rtol=1e-10, atol=1e-12)
    np.testing.assert_allclose(st.intercept, b, rtol=1e-10, atol=1e-12)


from hypothesis import given, settings, strategies as st_  # noqa: E402


@settings(max_examples=60, deadline=None)
@given(n=st_.integers(1, 40), d=st_.integers(1, 5), seed=st_.integers(0, 10_000),
       alpha=st_.floats(1e-4, 0.5), l2=st_.floats(0.0, 2.0))
def test_hinge_fold_property(n, d, seed, alpha, l2):
    r = np.random.default_rng(seed)
    X = r.normal(size=(n, d))
    y = np.where(r.random(n) > 0.5, 1.0, -1.0)
    w0, b0 = r.normal(size=d), float(r.normal())
    state = ShardState(w0.reshape(1, -1), np.array([b0]))
    fold_hinge(state, X, y, alpha, l2, True)
    w, b = ref_hinge(X, y, alpha, l2, w0, b0)
    np.testing.assert_allclose(state.coef[0], w, rtol=1e-9, atol=1e-12)
    assert state.intercept[0] == np.float64(b) or abs(state.intercept[0] - b) < 1e-12


@settings(max_examples=40, deadline=None)
@given(n=st_.integers(1, 30), d=st_.integers(1, 6), k=st_.integers(2, 6), seed=st_.integers(0, 10_000),
       alpha=st_.floats(1e-4, 0.2), l2=st_.floats(0.0, 0.1))
def test_multiclass_folds_property(n, d, k, seed, alpha, l2):
    r = np.random.default_rng(seed)
    X = r.normal(size=(n, d))
    y = r.integers(0, k, size=n)
    W0, b0 = r.normal(size=(k, d)) * 0.1, r.normal(size=k) * 0.1
    a = ShardState(W0, b0)
    fold_multiclass_hinge(a, X, y.astype(float), alpha, l2, True)
    W, b = ref_multi(X, y, alpha, l2, W0, b0)
    np.testing.assert_allclose(a.coef, W, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(a.intercept, b, rtol=1e-9, atol=1e-12)
    s = ShardState(W0, b0)
    fold_softmax(s, X, y.astype(float), alpha, 0.0, True)
    W, b = ref_softmax(X, y, alpha, W0, b0)
    np.testing.assert_allclose(s.coef, W, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(s.intercept, b, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("kind", ["hinge", "multiclass_hinge", "softmax"])
@pytest.mark.parametrize("l2, fit_intercept", [(0.0, True), (0.1, True), (0.01, False)])
def test_lockstep_equals_the_row_loop(kind, l2, fit_intercept):
    """Shards of unequal lengths, empty ones and one row included; stored order and a permuted one."""
    K, d = (1, 3) if kind == "hinge" else (4, 3)
    lengths = [7, 0, 40, 1, 23, 23, 5]
    n = sum(lengths)
    X = rng.normal(size=(n, d))
    y = np.where(rng.random(n) > 0.5, 1.0, -1.0) if kind == "hinge" else rng.integers(0, K, size=n).astype(float)
    coef, icpt = rng.normal(size=(K, d)), (rng.normal(size=K) if fit_intercept else np.zeros(K))
    at = np.concatenate([[0], np.cumsum(lengths)])
    mixed = np.concatenate([a + rng.permutation(b - a) for a, b in zip(at, at[1:])])
    for order in (None, mixed):
        W, b, loss = np.zeros((K, d)), np.zeros(K), 0.0
        for lo, hi in zip(at, at[1:]):
            rows = np.arange(lo, hi) if order is None else order[lo:hi]
            st = ShardState(coef, icpt)
            FOLDS[kind](st, X[rows], y[rows], 0.05, l2, fit_intercept)
            W, b, loss = W + st.coef, b + st.intercept, loss + st.loss_sum
        got = Lockstep(kind, coef, icpt, 0.05, l2, fit_intercept).run(X, y, lengths, order)
        np.testing.assert_allclose(got[0], W, rtol=1e-12, atol=1e-12)
        np.testing.assert_allclose(got[1], b, rtol=1e-12, atol=1e-12)
        assert got[2] == pytest.approx(loss, rel=1e-12)


def test_lockstep_softmax_survives_saturation():
    X = np.array([[1e4], [-1e4], [1e4]])
    W, b, loss = Lockstep("softmax", np.array([[1.0], [-1.0]]), np.zeros(2), 0.1, 0.0, True).run(X, np.array([0.0, 0.0, 1.0]), [2, 1])
    assert np.isfinite(W).all() and np.isfinite(b).all() and np.isfinite(loss)


def test_a_task_folds_buffered_and_streamed_shards_alike(monkeypatch):
    """Small buffers (many flushes, shards larger than the buffer) give the sums of one buffer."""
    from ridgeway.model import LinearModel
    from ridgeway.operators import sgd
    start = LinearModel(rng.normal(size=(3, 2)), rng.normal(size=3))
    lengths = [3, 200, 1, 50, 90, 2]
    X, y = rng.normal(size=(sum(lengths), 2)), rng.integers(0, 3, size=sum(lengths)).astype(float)
    cuts = np.concatenate([[0], np.cumsum(lengths)])

    def run(pieces):
        fold = sgd._TaskFold(sgd.SGDConfig(kind="softmax", alpha=0.05, l2=0.01), start)
        for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
            for part in np.array_split(np.arange(a, b), pieces):
                if len(part):
                    fold.add(s, X[part], y[part])
        return fold.result()

    whole = run(1)
    for limit in (1, 1000, 4000):
        monkeypatch.setattr(sgd, "LOCKSTEP_BYTES", limit)
        np.testing.assert_allclose(run(3), whole, rtol=1e-11, atol=1e-12)
    with pytest.raises(ValueError, match="contiguous"):
        fold = sgd._TaskFold(sgd.SGDConfig(kind="softmax"), start)
        fold.add(1, X[:2], y[:2])
        fold.add(0, X[:2], y[:2])
