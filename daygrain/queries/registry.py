"""Register a query together with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Decorator: the function's name becomes the query's name."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in _QUERIES:
            raise ValueError(f"query {key} is registered twice")
        _QUERIES[key] = function
        if sql is not None:
            _SQL[key] = sql.strip()
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
