from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trilode.spec import Expr


def as_column(expr: Expr) -> Column:
    """A ``Column`` as it is, a string as a Spark SQL expression."""
    return F.expr(expr) if isinstance(expr, str) else expr


# A plain, dotted or quoted column name, a direction, and where NULLs go.
_SORT_ITEM = re.compile(
    r"\s*(?:'(?P<quoted>[^']+)'|(?P<name>(?:`(?:[^`]|``)+`|\w+)(?:\.(?:`(?:[^`]|``)+`|\w+))*))"
    r"(?:\s+(?P<way>asc|desc))?(?:\s+nulls\s+(?P<nulls>first|last))?\s*",
    re.IGNORECASE,
)


def sort_column(item: Expr) -> Column:
    """``"col [ASC|DESC] [NULLS FIRST|LAST]"``; ascending puts NULLs first, descending last."""
    if isinstance(item, Column):
        return item
    parts = _SORT_ITEM.fullmatch(item)
    if not parts:
        raise ValueError(f"not a sort item: {item!r}")
    down = (parts["way"] or "").lower() == "desc"
    last = parts["nulls"].lower() == "last" if parts["nulls"] else down
    column = F.col(parts["name"] or parts["quoted"])
    if down:
        return column.desc_nulls_last() if last else column.desc_nulls_first()
    return column.asc_nulls_last() if last else column.asc_nulls_first()


_ORDER_ITEM = re.compile(
    r"(?P<expr>.+?)(?:\s+(?P<way>asc|desc))?(?:\s+nulls\s+(?P<nulls>first|last))?\s*",
    re.IGNORECASE | re.DOTALL,
)


def order_column(item: Expr) -> Column:
    """``"expression [ASC|DESC] [NULLS FIRST|LAST]"``, the expression being Spark SQL. (Parsed as a
    whole, a direction would be taken for an alias.)"""
    if isinstance(item, Column):
        return item
    parts = _ORDER_ITEM.fullmatch(item)
    if not parts:
        raise ValueError(f"not an order item: {item!r}")
    column = F.expr(parts["expr"])
    down = (parts["way"] or "").lower() == "desc"
    last = parts["nulls"].lower() == "last" if parts["nulls"] else down
    if down:
        return column.desc_nulls_last() if last else column.desc_nulls_first()
    return column.asc_nulls_last() if last else column.asc_nulls_first()


def sort_columns(sort: Sequence[Expr]) -> list[Column]:
    return [sort_column(item) for item in sort]
