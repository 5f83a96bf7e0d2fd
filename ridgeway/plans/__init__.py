"""Registered queries (one per operator of the inventory) and their oracle SQL."""

from ridgeway.plans import binary, full_batch, multiclass, text_io  # noqa: F401  (registers queries)
from ridgeway.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
