"""All registered queries."""

from anemos.plans import composite_queries, event_queries, feature_queries, join_queries, metric_queries, model_queries, source_queries, stream_queries  # noqa: F401
from anemos.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
