"""Registered queries and the SQL each is held against, gathered from the query modules."""

from __future__ import annotations

from geoloom.plans import queries as queries_
from geoloom.plans import queries_more, queries_sources, queries_tables  # noqa: F401  register further queries

FLAGSHIP = "fuzzy_spatial_fusion"


def queries() -> dict:
    """Query functions by name."""
    return dict(queries_.QUERIES)


def oracles() -> dict:
    """SQL text by query name."""
    return dict(queries_.ORACLES)
