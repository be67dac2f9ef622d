"""Queries over the given tables, each with the SQL that states its expected result."""

from __future__ import annotations

from tidelake.catalog import gold, governance, lake, scalars, series, silver  # noqa: F401  (they register)
from tidelake.catalog.base import ORACLES, QUERIES
from tidelake.catalog.sql import statement


def oracles() -> dict[str, str]:
    """SQL text of every query that has one."""
    return {name: statement(sql, *ctes) for name, (sql, ctes) in ORACLES.items()}


__all__ = ["QUERIES", "oracles"]
