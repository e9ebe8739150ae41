"""Gold: scalar metrics, grouped tables, trends."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilode.functions.exprs import as_column, sort_columns
from trilode.spec import UNBOUNDED_AGGREGATES, AggSpec, Expr, FlowSpec, GroupSpec, MetricSpec

OUTPUT = "__set"


def aggregate_column(agg: AggSpec) -> Column:
    if agg.column == "*":
        if agg.function.lower() != "count":
            raise ValueError(f"{agg.function}(*) is not an aggregate")
        return F.count(F.lit(1))
    return F.call_function(agg.function, F.col(agg.column))


def time_column(df: DataFrame, group: GroupSpec) -> Column:
    """The day, or the hour as a timestamp of the column's own kind: without a time zone there are
    no hours that a zone change could merge."""
    column = F.col(group.date_column)
    if group.grain == "day":
        return F.to_date(column)
    if isinstance(df.select(column).schema.fields[0].dataType, T.TimestampNTZType):
        parts = [F.year(column), F.month(column), F.day(column), F.hour(column)]
        return F.make_timestamp_ntz(*parts, F.lit(0), F.lit(0))
    return F.date_trunc("hour", column)


_UNBOUNDED = re.compile(rf"\b({'|'.join(sorted(UNBOUNDED_AGGREGATES))})\(", re.IGNORECASE)


def bounded(expression: Expr) -> Column:
    """The expression, unless one of its functions gathers all rows into one task."""
    column = as_column(expression)
    if found := _UNBOUNDED.search(str(column)):
        raise ValueError(f"{found[1]} keeps a whole table in one task")
    return column


def metrics(df: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """All scalar metrics from one scan, as one row named by the metrics' table names.

    Over no rows it is still one typed row.
    """
    return df.agg(*[bounded(m.expression).alias(m.name) for m in specs])


def metric_table(df: DataFrame, spec: MetricSpec) -> DataFrame:
    return df.agg(bounded(spec.expression).alias(spec.alias))


def group_table(df: DataFrame, spec: GroupSpec) -> DataFrame:
    if spec.date_column:
        df = df.withColumn(spec.time_key, time_column(df, spec))
    out = df.groupBy(*spec.keys).agg(*[aggregate_column(a).alias(a.alias) for a in spec.aggregates])
    return out.orderBy(*sort_columns(spec.sort)) if spec.sort else out


def top_n(df: DataFrame, sort: Sequence[Expr], n: int) -> DataFrame:
    return df.orderBy(*sort_columns(sort)).limit(n)


def build_gold(df: DataFrame, flow: FlowSpec) -> dict[str, DataFrame]:
    """Every output of the flow as its own lazy DataFrame."""
    tables = {m.name: metric_table(df, m) for m in flow.metrics}
    tables.update({g.name: group_table(df, g) for g in flow.groups})
    return {o.name: tables[o.name] for o in flow.outputs}


# ---------------------------------------------------------------- one scan for many groupings


class _Fused:
    """Shared names of a fused result: a column per key and a numbered column per measure."""

    def __init__(self, df: DataFrame, groups: Sequence[GroupSpec]):
        self.exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
        keys = [key for group in groups for key in self.keys(group)]
        self.key_columns = list(dict.fromkeys(keys))
        pairs = [self._pair(agg) for group in groups for agg in group.aggregates]
        self.measures = {pair: f"__m{i}" for i, pair in enumerate(dict.fromkeys(pairs))}

    def _name(self, column: str) -> str:
        return column if self.exact else column.lower()

    def _pair(self, agg: AggSpec) -> tuple[str, str]:
        return agg.function.lower(), self._name(agg.column)

    def keys(self, group: GroupSpec) -> tuple[str, ...]:
        if group.date_column:
            return (f"__{group.grain}_{self._name(group.date_column)}",)
        return tuple(f"__key_{self._name(name)}" for name in group.group_by)

    def measure(self, agg: AggSpec) -> str:
        return self.measures[self._pair(agg)]


def fused_groups(df: DataFrame, groups: Sequence[GroupSpec]) -> DataFrame:
    """All grouped outputs from one scan, as grouping sets over the union of their keys.

    Outputs with equal keys share a set and equal aggregates share a column. :func:`rows_of`
    takes one output out of the result again.
    """
    names = _Fused(df, groups)
    keys: dict[str, Column] = {}
    measures: dict[str, Column] = {}
    sets: list[tuple[str, ...]] = []
    for group in groups:
        mine = names.keys(group)
        sources = (
            [time_column(df, group)] if group.date_column else [F.col(c) for c in group.group_by]
        )
        keys.update(zip(mine, sources))
        measures.update({names.measure(a): aggregate_column(a) for a in group.aggregates})
        if set(mine) not in [set(s) for s in sets]:
            sets.append(mine)
    label = F.grouping_id()
    grouped = df.withColumns(keys).groupingSets([[F.col(c) for c in s] for s in sets], *keys)
    return grouped.agg(label.alias(OUTPUT), *[m.alias(n) for n, m in measures.items()])


def rows_of(fused: DataFrame, groups: Sequence[GroupSpec], group: GroupSpec) -> DataFrame:
    """One output out of :func:`fused_groups`, equal to ``group_table`` on the same input."""
    names = _Fused(fused, groups)
    bits, mine = names.key_columns, names.keys(group)
    code = sum(1 << (len(bits) - 1 - i) for i, c in enumerate(bits) if c not in mine)
    out = fused.filter(F.col(OUTPUT) == code).select(
        *[F.col(c).alias(k) for c, k in zip(mine, group.keys)],
        *[F.col(names.measure(a)).alias(a.alias) for a in group.aggregates],
    )
    return out.orderBy(*sort_columns(group.sort)) if group.sort else out
