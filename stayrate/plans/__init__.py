"""Registered queries (``QUERIES``) and their DuckDB oracle SQL (``ORACLES``)."""

from stayrate.plans.registry import ORACLES, QUERIES, finish, register
from stayrate.plans import q_features, q_eda, q_profile, q_metrics, q_prep, q_models, q_segments, q_risk, q_more  # noqa: F401  (registers queries)

__all__ = ["QUERIES", "ORACLES", "finish", "register"]
