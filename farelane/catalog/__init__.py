"""The registered queries and, where SQL can express them, their equivalents in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def load() -> None:
    """Import the modules that register queries."""
    for module in ("scans", "features", "filters", "stats", "demand", "samples", "models", "requests"):
        import_module(f"{__name__}.{module}")
