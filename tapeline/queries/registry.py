"""Query registry: name, Spark callable and, where SQL can express it, the check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is what DuckDB runs on the same tables."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return add
