"""Queries over the given tables, each with its DuckDB equivalent if there is one."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from signalstats.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tuned(function: Query) -> Query:
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return function(spark, sf_dir)

    return run


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in QUERIES:
            raise ValueError(f"query registered twice: {key}")
        QUERIES[key] = tuned(function)
        if sql is not None:
            ORACLES[key] = sql
        return function

    return register


def load() -> None:
    """Import the modules that register queries."""
    from registry import aggregates, events, operations, scalars, sql_text, streams  # noqa: F401
