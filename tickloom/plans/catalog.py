"""All registered queries."""

from tickloom.plans import q_indicators, q_load, q_models, q_reports, q_streams, q_views  # noqa: F401
from tickloom.plans.registry import REGISTRY, oracle_sql, queries

__all__ = ["REGISTRY", "oracle_sql", "queries"]
