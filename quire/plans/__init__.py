"""Registered queries over the driver tables: Spark plan + DuckDB oracle SQL per key."""

from quire.plans import docs_queries, io_queries, org_queries, results_queries, review_queries, spend_queries  # noqa: F401,E501
from quire.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
