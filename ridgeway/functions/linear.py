"""Scalar Column expressions for single-output linear models.

Everything here is a plain Catalyst expression, so it stays inside
whole-stage codegen and weights appear as literals (constant-folded).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def linear_predictor(features: Sequence[ColumnLike], coef: Sequence[float],
                     intercept: float = 0.0) -> Column:
    """z = b + w1*x1 + ... + wd*xd, accumulated left to right from the intercept."""
    if len(features) != len(coef):
        raise ValueError("feature and weight counts differ")
    z = F.lit(float(intercept))
    for x, w in zip(features, coef):
        z = z + F.lit(float(w)) * _col(x)
    return z


def dot_then_bias(features: Sequence[ColumnLike], coef: Sequence[float],
                  intercept: float = 0.0) -> Column:
    """z = (w1*x1 + ... + wd*xd) + b: the SVM scoring order (dot first)."""
    if not features:
        return F.lit(float(intercept))
    z = F.lit(float(coef[0])) * _col(features[0])
    for x, w in zip(features[1:], coef[1:]):
        z = z + F.lit(float(w)) * _col(x)
    return z + F.lit(float(intercept))


def dot_array(features: ColumnLike, coef: Sequence[float], intercept: float = 0.0) -> Column:
    """b + sum_j w_j * x[j] for an ``array<double>`` feature column."""
    w = F.array(*[F.lit(float(v)) for v in coef])
    prods = F.zip_with(_col(features), w, lambda a, b: a * b)
    return F.aggregate(prods, F.lit(float(intercept)), lambda acc, v: acc + v)


def sigmoid(z: ColumnLike) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(z)))


def logistic_nll(z: ColumnLike, y: ColumnLike) -> Column:
    """-y ln h - (1-y) ln(1-h) with h = sigmoid(z), in the overflow-free form
    max(z, 0) + log1p(exp(-|z|)) - y*z.  Finite for any finite z; the naive
    form gives ln(0) there, which Spark turns into NULL and ``sum`` would skip.
    """
    z, y = _col(z), _col(y)
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y * z


def squared_error(z: ColumnLike, y: ColumnLike) -> Column:
    r = _col(z) - _col(y)
    return r * r


def hinge_violation(z: ColumnLike, y: ColumnLike) -> Column:
    """Strict margin test y*z < 1 (an exact margin of 1 is not a violation)."""
    return (_col(y) * _col(z)) < F.lit(1.0)


def boundary_coordinate(features: Sequence[ColumnLike], coef: Sequence[float],
                        intercept: float, offset: float = 0.0) -> Column:
    """Last feature's coordinate on the line w.x + b = offset, given the others:

        x_d = (offset - b - w[:-1].x[:-1]) / w_d

    NULL when w_d == 0 (no such line).  ``offset`` 0 is the decision
    boundary; +1 / -1 are the margin lines.
    """
    head = F.lit(0.0)
    if len(features) > 1:
        head = dot_then_bias(features[:-1], coef[:-1], 0.0)
    if offset == 0.0:
        num = F.lit(-float(intercept)) - head
    else:
        num = F.lit(float(offset)) - F.lit(float(intercept)) - head
    return F.try_divide(num, F.lit(float(coef[-1])))
