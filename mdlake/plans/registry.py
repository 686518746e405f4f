"""Where query modules put their queries and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mdlake.plans.sql import statement

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; sql may use the derived tables by name."""

    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = statement(sql)
        return f

    return register
