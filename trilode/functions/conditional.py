"""Conditional aggregates. Rows that miss the condition count as zero, not as absent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trilode.functions.exprs import as_column
from trilode.spec import Expr


def sum_when(condition: Expr, value: Expr) -> Column:
    return F.sum(F.when(as_column(condition), as_column(value)).otherwise(0))


def avg_when(condition: Expr, value: Expr) -> Column:
    """The zeros stay in the denominator."""
    return F.avg(F.when(as_column(condition), as_column(value)).otherwise(0))


def count_when(condition: Expr) -> Column:
    """A sum of ones, so NULL (not 0) over no rows."""
    return F.sum(F.when(as_column(condition), 1).otherwise(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """NULL where the denominator is zero."""
    return F.try_divide(numerator, denominator)
