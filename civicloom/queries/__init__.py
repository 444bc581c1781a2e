"""Every operator bound to the test tables, each with its SQL twin where one exists."""

from civicloom.queries import (  # noqa: F401
    aggregates,
    annotation,
    dashboards,
    extensions,
    filters,
    joins,
    sampling,
    scalars,
    sources,
)
from civicloom.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
