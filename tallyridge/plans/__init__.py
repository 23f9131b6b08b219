"""Registered queries; importing the modules fills the catalog."""

from tallyridge.plans import demand, functions, items, learning, predictions, sources, streams, trips  # noqa: F401
from tallyridge.plans.catalog import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
