"""Type fixes that turn a malformed value into NULL instead of failing the job under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: str | Column) -> Column:
    """``'12.5' -> 12``, ``'abc' -> NULL``: truncates towards zero, NULL when out of range."""
    return _col(c).try_cast("double").try_cast("int")


def to_long(c: str | Column) -> Column:
    """Like :func:`to_int` for bigint; goes through decimal, since double is exact only to 2^53."""
    return _col(c).try_cast("decimal(38,6)").try_cast("bigint")


def to_double(c: str | Column) -> Column:
    return _col(c).try_cast("double")


def to_decimal(c: str | Column, precision: int, scale: int) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def to_day(c: str | Column) -> Column:
    return _col(c).try_cast("date")


def to_moment(c: str | Column) -> Column:
    return _col(c).try_cast("timestamp")
