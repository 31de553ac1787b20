"""Where queries and their SQL counterparts are registered by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if it can be written."""

    def register(function: Query) -> Query:
        name = function.__name__
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


def rounded(columns, digits: int = 6) -> str:
    """SQL select list of rounded columns under their own names."""
    return ", ".join(f"ROUND({c}, {digits}) AS {c}" for c in columns)
