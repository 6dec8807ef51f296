"""Queries by name: a Spark function and, where SQL can say it, its oracle text."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from queries.views import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` may use the views by name."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = oracle(sql)
        return fn
    return register
