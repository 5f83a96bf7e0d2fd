"""Spark operators: gradients, steps, GD and averaged-SGD trainers, scoring."""

from ridgeway._lazy import lazy_exports

_EXPORTS = {
    "GDConfig": "ridgeway.operators.gd",
    "GDResult": "ridgeway.operators.gd",
    "SGDConfig": "ridgeway.operators.sgd",
    "SGDResult": "ridgeway.operators.sgd",
    "accuracy": "ridgeway.operators.scoring",
    "boundary_lines": "ridgeway.operators.scoring",
    "decision_score": "ridgeway.operators.scoring",
    "first_n_by": "ridgeway.operators.sample",
    "gradient_long_form": "ridgeway.operators.gradient",
    "gradient_stats": "ridgeway.operators.gradient",
    "gradient_step_join": "ridgeway.operators.gradient",
    "gradient_table": "ridgeway.operators.gradient",
    "gram_stats": "ridgeway.operators.gradient",
    "l2_penalty": "ridgeway.operators.gradient",
    "loss_summary": "ridgeway.operators.gradient",
    "ranked_classes": "ridgeway.operators.scoring",
    "score_with_model_table": "ridgeway.operators.scoring",
    "sgd_pass": "ridgeway.operators.sgd",
    "train_gd": "ridgeway.operators.gd",
    "train_sgd": "ridgeway.operators.sgd",
    "train_gd_blocked": "ridgeway.operators.blocked",
    "with_class_scores": "ridgeway.operators.scoring",
    "with_prediction": "ridgeway.operators.scoring",
    "with_probabilities": "ridgeway.operators.scoring",
}

__getattr__, __dir__ = lazy_exports(__name__, _EXPORTS)
__all__ = sorted(_EXPORTS)
