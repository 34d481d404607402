"""Named queries over the shared test tables, each with the SQL that must give the same rows."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its check, absent where SQL cannot express the result."""

    def add(func: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = func
        if sql is not None:
            SQL[name] = sql
        return func

    return add


def load() -> None:
    from panelwise.catalog import evaluating, learning, panels, rules, storing, summaries  # noqa: F401
