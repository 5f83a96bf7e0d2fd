"""Array-valued Column expressions for K-class models over ``array<double>``.

These use Spark's higher-order functions and suit narrow models; wide
models score through :mod:`ridgeway.operators.scoring`'s Arrow path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridgeway.functions.linear import ColumnLike, _col, dot_array
from ridgeway.model import LinearModel


def class_scores(features: ColumnLike, model: LinearModel) -> Column:
    """[b_k + W_k . x for k in 0..K-1] as ``array<double>``."""
    return F.array(*[dot_array(features, model.coef[k], model.intercept[k])
                     for k in range(model.n_classes)])


def softmax(scores: ColumnLike) -> Column:
    """Per-row softmax, shifted by the row maximum so exp cannot overflow."""
    s = _col(scores)
    m = F.array_max(s)
    e = F.transform(s, lambda v: F.exp(v - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(e, lambda v: v / total)


def argmax(scores: ColumnLike) -> Column:
    """Index of the largest score; ties go to the lowest index."""
    s = _col(scores)
    return (F.array_position(s, F.array_max(s)) - F.lit(1)).cast("int")


def one_hot(label: ColumnLike, n_classes: int) -> Column:
    y = _col(label)
    return F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)),
                       lambda k: (k == y).cast("double"))


def multiclass_margins(scores: ColumnLike, label: ColumnLike) -> Column:
    """s_k - s_y + 1 for k != y, and 0 for the own class (Weston-Watkins)."""
    s, y = _col(scores), _col(label)
    sy = F.element_at(s, y + F.lit(1))
    return F.transform(s, lambda v, k: F.when(k == y, F.lit(0.0))
                       .otherwise(v - sy + F.lit(1.0)))


def violation_count(margins: ColumnLike) -> Column:
    return F.size(F.filter(_col(margins), lambda m: m > F.lit(0.0)))


def hinge_coefficients(margins: ColumnLike, label: ColumnLike) -> Column:
    """1 where a margin is violated, minus the violation count at the own class."""
    m, y = _col(margins), _col(label)
    cnt = violation_count(m).cast("double")
    return F.transform(m, lambda v, k: F.when(k == y, -cnt)
                       .otherwise((v > F.lit(0.0)).cast("double")))
