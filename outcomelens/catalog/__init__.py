"""Queries over the driver tables, one or more per operator, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can state it, its oracle."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    from outcomelens.catalog import (  # noqa: F401
        compare_queries,
        error_queries,
        io_queries,
        job_queries,
        metric_queries,
        model_queries,
        rate_queries,
        row_queries,
        sample_queries,
    )
