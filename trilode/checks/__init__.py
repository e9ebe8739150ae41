"""Queries over the driver's tables, each next to the SQL that must give the same rows."""

from trilode.checks import bronze, domains, gold, increment, quality, silver  # noqa: F401  (they register)
from trilode.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
