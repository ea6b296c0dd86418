"""Queries over the catalogue operators, with the SQL that must give the same rows."""

from __future__ import annotations

from .plans import catalogue, more, page_queries, refresh, runs, scalars  # noqa: F401
from .plans.registry import ORACLES, QUERIES

FLAGSHIP = refresh.observed_pricing

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
