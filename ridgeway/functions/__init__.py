"""Column expressions for linear and K-class models."""

from ridgeway._lazy import lazy_exports

_EXPORTS = {
    "argmax": "ridgeway.functions.multiclass",
    "boundary_coordinate": "ridgeway.functions.linear",
    "class_scores": "ridgeway.functions.multiclass",
    "dot_array": "ridgeway.functions.linear",
    "dot_then_bias": "ridgeway.functions.linear",
    "hinge_coefficients": "ridgeway.functions.multiclass",
    "hinge_violation": "ridgeway.functions.linear",
    "linear_predictor": "ridgeway.functions.linear",
    "logistic_nll": "ridgeway.functions.linear",
    "multiclass_margins": "ridgeway.functions.multiclass",
    "one_hot": "ridgeway.functions.multiclass",
    "sigmoid": "ridgeway.functions.linear",
    "softmax": "ridgeway.functions.multiclass",
    "squared_error": "ridgeway.functions.linear",
    "violation_count": "ridgeway.functions.multiclass",
}

__getattr__, __dir__ = lazy_exports(__name__, _EXPORTS)
__all__ = sorted(_EXPORTS)
