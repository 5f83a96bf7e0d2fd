"""Sequential per-row update rules (one shard's SGD pass).

These run inside a ``mapInArrow`` task over one shard's rows in their
epoch order.  Each row sees the model left by the previous one of its shard, so a single
shard is a row loop (``fold_*``); many shards of a task go in lockstep (:class:`Lockstep`).
Placement, ordering and averaging are done by Spark.

State per shard: ``coef`` (K x d), ``intercept`` (K), ``n_rows``,
``loss_sum``; the loss is the online (progressive) loss of each row under
the model *before* that row's update.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

KINDS = ("hinge", "multiclass_hinge", "softmax")


class ShardState:
    __slots__ = ("coef", "intercept", "n_rows", "loss_sum")

    def __init__(self, coef: np.ndarray, intercept: np.ndarray) -> None:
        self.coef = coef.copy()
        self.intercept = intercept.copy()
        self.n_rows = 0
        self.loss_sum = 0.0


def fold_hinge(st: ShardState, X: np.ndarray, y: np.ndarray, alpha: float, l2: float,
               fit_intercept: bool) -> None:
    """Binary hinge (labels +-1): on y*z < 1 (strict)
    w <- w - alpha*(l2*w - y*x), b <- b + alpha*y; otherwise w <- w - alpha*l2*w.
    Plain floats: d is small and scalar math beats tiny numpy arrays per row.
    """
    w = [float(v) for v in st.coef[0]]
    b = float(st.intercept[0])
    d = len(w)
    loss = st.loss_sum
    rng = range(d)
    for xr, yi in zip(X.tolist(), y.tolist()):
        z = 0.0
        for j in rng:
            z += xr[j] * w[j]
        z = z + b
        m = yi * z
        if m < 1.0:
            loss += 1.0 - m
            for j in rng:
                w[j] = w[j] - alpha * (w[j] * l2 - yi * xr[j])
            if fit_intercept:
                b = b - alpha * (-yi)
        else:
            for j in rng:
                w[j] = w[j] - alpha * (w[j] * l2)
    st.coef[0, :] = w
    st.intercept[0] = b
    st.n_rows += len(y)
    st.loss_sum = loss


def fold_multiclass_hinge(st: ShardState, X: np.ndarray, y: np.ndarray, alpha: float,
                          l2: float, fit_intercept: bool) -> None:
    """Weston-Watkins multiclass hinge: margins m_k = s_k - s_y + 1 (own class 0),
    c_k = 1[m_k > 0] (k != y), c_y = -sum c;  W <- W - alpha*(c x^T + l2*W), b <- b - alpha*c.
    The update runs in preallocated buffers with the same rounding steps as the formula.
    """
    W, b = st.coef, st.intercept
    upd = np.empty_like(W)
    dec = np.empty_like(W)
    s = np.empty(W.shape[0])
    loss = st.loss_sum
    for i in range(len(y)):
        x = X[i]
        yi = int(y[i])
        np.dot(W, x, out=s)
        s += b
        m = s - s[yi]
        m += 1.0
        m[yi] = 0.0
        pos = m > 0.0
        c = pos.astype(np.float64)
        c[yi] = -c.sum()
        loss += float(m[pos].sum())
        np.multiply.outer(c, x, out=upd)     # c x^T
        np.multiply(W, l2, out=dec)          # l2 W
        upd += dec
        upd *= alpha
        W -= upd
        if fit_intercept:
            b -= alpha * c
    st.n_rows += len(y)
    st.loss_sum = loss


def fold_softmax(st: ShardState, X: np.ndarray, y: np.ndarray, alpha: float, l2: float,
                 fit_intercept: bool) -> None:
    """Multinomial logistic: p = softmax(W x + b) (max-shifted),
    W <- W + alpha*((onehot - p) x^T - l2*W), b <- b + alpha*(onehot - p).
    The decay is a shrinkage; at l2 = 0 (how the reference runs it) it is inert.
    """
    W, b = st.coef, st.intercept
    upd = np.empty_like(W)
    dec = np.empty_like(W)
    s = np.empty(W.shape[0])
    loss = st.loss_sum
    for i in range(len(y)):
        x = X[i]
        yi = int(y[i])
        np.dot(W, x, out=s)
        s += b
        mx = s.max()
        e = np.exp(s - mx)
        tot = e.sum()
        g = e / tot
        loss += -(s[yi] - mx) + math.log(tot)
        np.negative(g, out=g)                # onehot - p
        g[yi] += 1.0
        np.multiply.outer(g, x, out=upd)     # (onehot - p) x^T
        if l2:
            np.multiply(W, l2, out=dec)
            upd -= dec
        upd *= alpha
        W += upd
        if fit_intercept:
            b += alpha * g
    st.n_rows += len(y)
    st.loss_sum = loss


class Lockstep:
    """The passes of many shards side by side: step r is one batched numpy step over row r of every shard
    that has one.  Shards are independent until they are averaged, so the result is that of
    folding them one after another (to the rounding of sums).

    ``coef`` (G x K x d) and ``intercept`` (G x K) hold the G shard models, longest shard first, so
    the shards that still have rows are always the first ones.
    """

    def __init__(self, kind: str, coef: np.ndarray, intercept: np.ndarray, alpha: float, l2: float,
                 fit_intercept: bool) -> None:
        self.kind, self.start = kind, (coef, intercept)
        self.alpha, self.l2, self.fit_intercept = alpha, l2, fit_intercept

    def run(self, X: np.ndarray, y: np.ndarray, lengths: np.ndarray, order: np.ndarray | None = None):
        """-> (sum of the shard models: coef K x d, intercept K; online loss sum).

        Rows of a shard are contiguous in ``X`` and ``y`` (``lengths`` a shard); ``order`` is the row number
        of each step, shard by shard (default: as stored)."""
        lengths = np.asarray(lengths)
        offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        by_length = np.argsort(-lengths, kind="stable")
        lengths, offsets = lengths[by_length], offsets[by_length]
        G = len(lengths)
        coef, intercept = self.start
        self.W, self.b = np.repeat(coef[None], G, axis=0), np.repeat(intercept[None], G, axis=0)
        self.loss = np.zeros(G)
        steps = int(lengths[0]) if G else 0
        active = np.searchsorted(-lengths, -np.arange(steps), side="left")   # shards with more than r rows
        step = getattr(self, f"_{self.kind}")
        classes = y.astype(np.intp) if self.kind != "hinge" else y
        for r in range(steps):
            a = active[r]
            at = offsets[:a] + r
            if order is not None:
                at = order[at]
            step(a, X[at], classes[at])
        return self.W.sum(axis=0), self.b.sum(axis=0), float(self.loss.sum())

    def _hinge(self, a: int, x: np.ndarray, y: np.ndarray) -> None:
        w, b = self.W[:a, 0], self.b[:a, 0]
        m = y * ((x * w).sum(axis=1) + b)
        hit = m < 1.0
        self.loss[:a] += np.where(hit, 1.0 - m, 0.0)
        pull = np.where(hit, y, 0.0)
        w -= self.alpha * (w * self.l2 - pull[:, None] * x)
        if self.fit_intercept:
            b += self.alpha * pull

    def _scores(self, a: int, x: np.ndarray) -> np.ndarray:
        return np.matmul(self.W[:a], x[:, :, None])[:, :, 0] + self.b[:a]

    def _move(self, a: int, x: np.ndarray, g: np.ndarray) -> None:
        """W -= alpha (g x' + l2 W), b -= alpha g."""
        W = self.W[:a]
        upd = g[:, :, None] * x[:, None, :]
        if self.l2:
            upd += self.l2 * W
        upd *= self.alpha
        W -= upd
        if self.fit_intercept:
            self.b[:a] -= self.alpha * g

    def _multiclass_hinge(self, a: int, x: np.ndarray, y: np.ndarray) -> None:
        rows = np.arange(a)
        s = self._scores(a, x)
        m = s - s[rows, y][:, None] + 1.0
        m[rows, y] = 0.0
        pos = m > 0.0
        c = pos.astype(np.float64)
        c[rows, y] = -c.sum(axis=1)
        self.loss[:a] += np.where(pos, m, 0.0).sum(axis=1)
        self._move(a, x, c)

    def _softmax(self, a: int, x: np.ndarray, y: np.ndarray) -> None:
        rows = np.arange(a)
        s = self._scores(a, x)
        s -= s.max(axis=1)[:, None]
        e = np.exp(s)
        tot = e.sum(axis=1)
        self.loss[:a] += np.log(tot) - s[rows, y]
        e /= tot[:, None]
        e[rows, y] -= 1.0
        self._move(a, x, e)


# A lockstep step costs some numpy calls however few shards it holds; below these counts
# the row loops are faster (plan only).
LOCKSTEP_SHARDS = {"hinge": 10, "multiclass_hinge": 2, "softmax": 2}


def fold_shards(kind: str, coef: np.ndarray, intercept: np.ndarray, X: np.ndarray, y: np.ndarray, lengths: Sequence[int],
                alpha: float, l2: float, fit_intercept: bool, order: np.ndarray | None = None):
    """-> (sum of the shard models' coef, of their intercept, online loss sum) of shards that lie one after
    another in ``X`` and ``y``, each folded from the same start."""
    if len(lengths) >= LOCKSTEP_SHARDS[kind]:
        return Lockstep(kind, coef, intercept, alpha, l2, fit_intercept).run(X, y, lengths, order)
    W, b, loss, at = np.zeros_like(coef), np.zeros_like(intercept), 0.0, 0
    for n in lengths:
        rows = slice(at, at + n) if order is None else order[at:at + n]
        st = ShardState(coef, intercept)
        FOLDS[kind](st, X[rows], y[rows], alpha, l2, fit_intercept)
        W += st.coef
        b += st.intercept
        loss += st.loss_sum
        at += n
    return W, b, loss


FOLDS = {"hinge": fold_hinge, "multiclass_hinge": fold_multiclass_hinge, "softmax": fold_softmax}
