"""Registered queries and the SQL that each is held against."""

from mdlake.plans import catalog_queries, plan_queries, stream_queries, universe_queries  # noqa: F401
from mdlake.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
