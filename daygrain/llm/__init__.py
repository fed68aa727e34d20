"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""

from daygrain.llm import queries as _queries  # noqa: F401  registers the queries
from daygrain.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
