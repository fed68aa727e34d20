"""The operators on the driver's tables, each with SQL for the same result."""

from daygrain.queries import (
    analyses,
    calendar,
    conditions,
    days,
    files,
    groups,
    models,
    rows,
)
from daygrain.queries.registry import oracle_sql, queries

__all__ = [
    "analyses", "calendar", "conditions", "days", "files", "groups", "models", "oracle_sql", "queries", "rows",
]
