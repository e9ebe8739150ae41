from trilode.functions.casts import to_day, to_decimal, to_double, to_int, to_long, to_moment
from trilode.functions.conditional import avg_when, count_when, ratio, sum_when
from trilode.functions.exprs import as_column, sort_columns
from trilode.functions.predicates import (
    EMAIL_PATTERN,
    at_least,
    at_most,
    equals,
    is_flag,
    matches,
    not_future,
    one_of,
    positive,
    within,
)

__all__ = [
    "EMAIL_PATTERN", "as_column", "at_least", "at_most", "avg_when", "count_when", "equals",
    "is_flag", "matches", "not_future", "one_of", "positive", "ratio", "sort_columns", "sum_when",
    "to_day", "to_decimal", "to_double", "to_int", "to_long", "to_moment", "within",
]
