"""ridgeway: linear-model training and scoring on Spark DataFrames.

Full-batch gradient descent (squared error with L2, logistic) runs one
Catalyst aggregate per epoch (or a single Gram pass for squared error);
parameter-averaged SGD (binary hinge, multiclass hinge, softmax) folds rows
sequentially inside explicit shards with ``mapInArrow`` and averages the
shard models with an ordinary aggregate.  Models and histories are small
tables; only model-sized results ever reach the driver.
"""

import sys as _sys

from ridgeway._lazy import lazy_exports

# Functions that run inside Python workers (SGD folds, Arrow gradient and scoring
# batches) are shipped by value, so executors need numpy/pyarrow but not this
# package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover - older cloudpickle
    pass

_EXPORTS = {
    "LinearModel": "ridgeway.model",
    "LinearRegressionGD": "ridgeway.estimators",
    "LogisticRegressionGD": "ridgeway.estimators",
    "MLR": "ridgeway.estimators",
    "MultiSVM": "ridgeway.estimators",
    "SVM": "ridgeway.estimators",
    "get_session": "ridgeway.session",
    "scratch_path": "ridgeway.session",
}

__getattr__, __dir__ = lazy_exports(__name__, _EXPORTS)
__all__ = sorted(_EXPORTS)
