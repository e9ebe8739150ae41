"""Validation predicates. All are NULL on NULL, so a filter drops the row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the default e-mail pattern.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def not_future(column: str) -> Column:
    return F.col(column) <= F.current_date()


def positive(column: str) -> Column:
    return F.col(column) > 0


def at_least(column: str, low) -> Column:
    return F.col(column) >= low


def at_most(column: str, high) -> Column:
    return F.col(column) <= high


def within(column: str, low, high) -> Column:
    """Inclusive on both ends."""
    return F.col(column).between(low, high)


def equals(column: str, value) -> Column:
    return F.col(column) == value


def one_of(column: str, values: Iterable) -> Column:
    return F.col(column).isin(list(values))


def is_flag(column: str) -> Column:
    """A boolean that is set, either way."""
    return F.col(column).isin(True, False)


def matches(column: str, pattern: str = EMAIL_PATTERN) -> Column:
    return F.col(column).rlike(pattern)
