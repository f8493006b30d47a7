"""Every operator as a named query over the given tables, with its SQL twin."""

from roadpulse.catalog import batch, streams  # noqa: F401 - fill the registry
from roadpulse.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
