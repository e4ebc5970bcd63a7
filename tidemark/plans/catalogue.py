"""All registered queries; importing the modules fills the registry."""

from tidemark.plans import (  # noqa: F401
    activity_queries,
    churn_queries,
    compare_queries,
    expression_queries,
    feature_queries,
    join_queries,
    quality_queries,
    source_queries,
    streaming_queries,
    trend_queries,
)
from tidemark.plans.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
