"""Estimator objects with the reference's surface: ``fit`` / ``partial_fit`` /
``predict`` (+ boundary and margin lines for the binary SVM), over DataFrames.

Each call is one of the Spark operators of :mod:`ridgeway.operators`; the
estimator only holds its parameters and the current (model-sized) weights.

* ``fit`` runs ``n_epochs`` / ``max_iter`` passes.  ``shards=1`` is the
  single-machine loop (one sequential pass per epoch, rows re-ordered every
  epoch); ``shards > 1`` is the parameter-averaged parallel form, which also
  applies the ``tol`` stop test after each averaged pass.
* ``partial_fit`` is one pass from the current model (zero on first use).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeway.model import LinearModel
from ridgeway.operators.gd import GDConfig, train_gd
from ridgeway.operators.scoring import (boundary_lines, decision_score, with_class_scores,
                                        with_prediction, with_probabilities)
from ridgeway.operators.sgd import SGDConfig, infer_shape, sgd_pass, train_sgd
from ridgeway.functions.linear import linear_predictor, sigmoid


class _SGDEstimator:
    kind = "hinge"

    def __init__(self, alpha: float, max_iter: int, l: float, fit_intercept: bool, tol: float,
                 shards: int, order: str, id_col: str, features: Sequence[str] | str, label: str) -> None:
        self.alpha, self.max_iter, self.l, self.tol = alpha, max_iter, l, tol
        self.fit_intercept, self.shards, self.order = fit_intercept, shards, order
        self.id_col, self.features, self.label = id_col, features, label
        self.model: LinearModel | None = None
        self.history: list[tuple] = []
        self._passes = 0

    def _cfg(self, max_iter: int, tol: float, order: str) -> SGDConfig:
        return SGDConfig(kind=self.kind, alpha=self.alpha, l2=self.l, fit_intercept=self.fit_intercept,
                         shards=self.shards, max_iter=max_iter, tol=tol, order=order)

    def fit(self, df: DataFrame, log=None) -> "_SGDEstimator":
        """``log``: an optional TrainingLog; a restarted fit continues after its last epoch."""
        tol = self.tol if self.shards > 1 else -1.0  # the single-machine loop has no stop test
        res = train_sgd(df, self.id_col, self.features, self.label, self._cfg(self.max_iter, tol, self.order),
                        log=log)
        self.model, self.history = res.model, res.history
        self._passes = len(res.history)
        return self

    def partial_fit(self, df: DataFrame, n_classes: int | None = None) -> "_SGDEstimator":
        if self.model is None:
            K, d = infer_shape(df, self.features, self.label, self.kind)
            self.model = LinearModel.zeros(n_classes or K, d)
        self._passes += 1
        self.model, _, _ = sgd_pass(df, self.id_col, self.features, self.label,
                                    self._cfg(1, 0.0, "id"), self.model, self._passes)
        return self

    def _fitted(self) -> LinearModel:
        if self.model is None:
            raise ValueError("not fitted")
        return self.model


class SVM(_SGDEstimator):
    """Binary hinge SVM (labels +-1) on scalar feature columns."""

    kind = "hinge"

    def __init__(self, alpha: float = 0.01, n_epochs: int = 20, l: float = 1.0, fit_intercept: bool = True,
                 tol: float = 1e-3, shards: int = 1, order: str = "hash", id_col: str = "id",
                 features: Sequence[str] = ("x1", "x2"), label: str = "y") -> None:
        super().__init__(alpha, n_epochs, l, fit_intercept, tol, shards, order, id_col, list(features), label)

    def predict(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Raw decision scores w.x + b."""
        return decision_score(df, self.features, self._fitted(), out)

    def hyperplane_coord(self, df: DataFrame, out: str = "boundary") -> DataFrame:
        return boundary_lines(df, self.features, self._fitted(), {out: 0.0})

    def support_vec(self, df: DataFrame, off: float, out: str = "margin_line") -> DataFrame:
        return boundary_lines(df, self.features, self._fitted(), {out: float(off)})


class MultiSVM(_SGDEstimator):
    """Multiclass (Weston-Watkins) hinge on an ``array<double>`` feature column."""

    kind = "multiclass_hinge"

    def __init__(self, alpha: float = 0.01, tol: float = 1e-3, max_iter: int = 1000, l: float = 1.0,
                 fit_intercept: bool = True, shards: int = 1, order: str = "hash", id_col: str = "id",
                 features: str = "features", label: str = "label") -> None:
        super().__init__(alpha, max_iter, l, fit_intercept, tol, shards, order, id_col, features, label)

    def decision_function(self, df: DataFrame, out: str = "scores") -> DataFrame:
        return with_class_scores(df, self.features, self._fitted(), out)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return with_prediction(self.decision_function(df), "scores", out)


class MLR(MultiSVM):
    """Multinomial logistic regression (softmax) on an ``array<double>`` column."""

    kind = "softmax"

    def __init__(self, alpha: float = 0.05, tol: float = 1e-3, max_iter: int = 500, l: float = 0.0,
                 fit_intercept: bool = True, shards: int = 1, order: str = "hash", id_col: str = "id",
                 features: str = "features", label: str = "label") -> None:
        super().__init__(alpha, tol, max_iter, l, fit_intercept, shards, order, id_col, features, label)

    def predict_proba(self, df: DataFrame, out: str = "probs") -> DataFrame:
        return with_probabilities(self.decision_function(df), "scores", out)


class _GDEstimator:
    loss = "squared"

    def __init__(self, features: Sequence[str], label: str, **cfg) -> None:
        self.features, self.label = list(features), label
        self.cfg = GDConfig(loss=self.loss, **cfg)
        self.model: LinearModel | None = None
        self.history: list[tuple] = []

    def fit(self, df: DataFrame, init: LinearModel | Sequence[float] | None = None,
            log=None) -> "_GDEstimator":
        """``log``: an optional TrainingLog; a restarted fit continues after its last epoch."""
        res = train_gd(df, self.features, self.label, self.cfg, init=init, log=log)
        self.model, self.history = res.model, res.history
        return self

    def _z(self):
        m = self.model
        if m is None:
            raise ValueError("not fitted")
        return linear_predictor(self.features, m.coef[0], m.intercept[0])


class LinearRegressionGD(_GDEstimator):
    """Squared error with L2 (decay 2*l2*w per step, intercept not decayed)."""

    loss = "squared"

    def __init__(self, features: Sequence[str], label: str = "y", lr: float = 0.001, l2: float = 0.001,
                 tol: float = 1e-4, max_epochs: int = 100000, method: str = "auto") -> None:
        super().__init__(features, label, lr=lr, l2=l2, tol=tol, max_epochs=max_epochs, method=method)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self._z())


class LogisticRegressionGD(_GDEstimator):
    """Binary logistic loss, labels 0/1."""

    loss = "logistic"

    def __init__(self, features: Sequence[str], label: str = "y", lr: float = 0.15, tol: float = 1e-4,
                 max_epochs: int = 100000) -> None:
        super().__init__(features, label, lr=lr, tol=tol, max_epochs=max_epochs)

    def predict_proba(self, df: DataFrame, out: str = "prob") -> DataFrame:
        return df.withColumn(out, sigmoid(self._z()))

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, (sigmoid(self._z()) >= F.lit(0.5)).cast("double"))
