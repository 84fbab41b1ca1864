"""Registry of named queries: a Spark callable and, where SQL can express
the result, the oracle SQL text (DuckDB dialect, driver tables as views)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        if key in _QUERIES:
            raise ValueError(f"query {key!r} registered twice")
        _QUERIES[key] = fn
        if sql is not None:
            _ORACLES[key] = sql
        return fn

    return wrap


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
