"""Silver: type fixes, null handling, validation and de-duplication."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilode.functions.exprs import as_column, order_column
from trilode.spec import CleaningSpec, Expr, RuleSpec

KEY_HASH = "__key_hash"
RANK = "__survivor_rank"
FAILED_RULES = "failed_rules"
REJECT = "__reject"
MISSING = "__missing"
MOST_BITS = 62


def has_column(df: DataFrame, column: str) -> bool:
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return column in df.columns
    return column.lower() in [c.lower() for c in df.columns]


def type_of(df: DataFrame, column: str) -> T.DataType:
    return df.select(column).schema.fields[0].dataType


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail while planning, not while running, when the input lacks a promised column."""
    missing = [c for c in columns if not has_column(df, c)]
    if missing:
        raise ValueError(f"missing columns {missing}, input has {df.columns}")
    return df


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The column contract as a projection."""
    return require_columns(df, columns).select(*columns)


def fix_types(df: DataFrame, fixes: Mapping[str, Expr]) -> DataFrame:
    """Replace columns in order; a later fix sees the earlier ones."""
    if _independent(fixes):
        return df.withColumns({name: as_column(e) for name, e in fixes.items()}) if fixes else df
    return reduce(lambda d, fix: d.withColumn(fix[0], as_column(fix[1])), fixes.items(), df)


def _independent(fixes: Mapping[str, Expr]) -> bool:
    """True only if no fix can possibly read another fixed column."""
    if any(isinstance(e, Column) for e in fixes.values()):
        return False
    names = {name.lower() for name in fixes}
    return all(
        not (set(re.findall(r"\w+", text.lower())) & (names - {name.lower()}))
        for name, text in fixes.items()
    )


def present(df: DataFrame, column: str) -> Column:
    """Neither NULL nor, in a floating-point column, NaN."""
    there = F.col(column).isNotNull()
    if isinstance(type_of(df, column), (T.DoubleType, T.FloatType)):
        there = there & ~F.isnan(column)
    return there


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop a row when any listed column is missing.

    Keeps the rows ``dropna(subset=columns)`` keeps. Written as plain predicates it also reaches
    the scan, which skips Parquet row groups by their null counts.
    """
    return reduce(lambda d, c: d.filter(present(d, c)), columns, df)


def _given(df: DataFrame, column: str) -> Column:
    if isinstance(type_of(df, column), (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(column), F.lit(None).cast(type_of(df, column)))
    return F.col(column)


def fill_nulls(df: DataFrame, defaults: Mapping[str, Expr]) -> DataFrame:
    """Put a default, given as a SQL literal, for NULL and, in a floating-point column, for NaN; the
    column keeps its type."""
    filled = {
        name: F.coalesce(_given(df, name), as_column(default).cast(type_of(df, name)))
        for name, default in defaults.items()
    }
    return df.withColumns(filled) if filled else df


def apply_rules(df: DataFrame, rules: Sequence[RuleSpec]) -> DataFrame:
    """Keep rows that satisfy every rule; a NULL outcome drops the row."""
    return reduce(lambda d, r: d.filter(as_column(r.rule)), rules, df)


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Expr] = ()) -> DataFrame:
    """One row per key; NULL keys are equal to each other.

    Without ``order`` an arbitrary row survives. With it the first row in that order survives.
    Either way copies are thinned out before the shuffle, so a key with very many copies sends one
    row per input partition. Both plans sort by key; a hash in front of the key makes nearly every
    comparison one of two integers, whatever the key consists of. Keys with a collation stay out of
    the hash, as equal ones can have different bytes.
    """
    if not keys:
        return df
    plain = [k for k in keys if "collate" not in type_of(df, k).simpleString()]
    hashed = df.withColumn(KEY_HASH, F.xxhash64(*plain) if plain else F.lit(0))
    if not order:
        return hashed.dropDuplicates([KEY_HASH, *keys]).drop(KEY_HASH)
    first = Window.partitionBy(KEY_HASH, *keys).orderBy(*[order_column(o) for o in order])
    ranked = hashed.withColumn(RANK, F.row_number().over(first))
    return ranked.filter(F.col(RANK) == 1).drop(RANK, KEY_HASH)


def clean(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    df = fix_types(df, spec.type_fixes)
    df = drop_nulls(df, spec.null_drop)
    df = fill_nulls(df, spec.null_fill)
    df = apply_rules(df, spec.rules)
    return dedup(df, spec.dedup_keys, spec.dedup_order)


def failure_bits(spec: CleaningSpec) -> list[str]:
    """What each bit of ``failed_rules`` stands for, from the lowest on: the rules, then the columns
    that must not be missing."""
    names = [r.description or r.column for r in spec.rules]
    names += [f"no {column}" for column in spec.null_drop]
    if len(names) > MOST_BITS:
        raise ValueError(f"{len(names)} rules and required columns, at most {MOST_BITS} can be told apart")
    return names


def _mask(failures: Sequence[Column], first: int) -> Column:
    bits = [F.when(f, F.lit(1 << (first + i))).otherwise(F.lit(0)) for i, f in enumerate(failures)]
    return reduce(lambda a, b: a + b, bits, F.lit(0).cast("bigint"))


def judge(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """All rows, typed and filled, with a bit mask ``failed_rules`` of what keeps them out of Silver.

    It is 0 for a row that :func:`clean` would keep or take for a copy. A row that misses a
    required column is not held against the rules.
    """
    failure_bits(spec)
    fixed = fix_types(df, spec.type_fixes)
    gaps = _mask([~present(fixed, c) for c in spec.null_drop], len(spec.rules))
    filled = fill_nulls(fixed.withColumn(MISSING, gaps), spec.null_fill)
    broken = _mask([~F.coalesce(as_column(r.rule), F.lit(False)) for r in spec.rules], 0)
    mask = F.when(F.col(MISSING) == 0, broken).otherwise(F.col(MISSING))
    return filled.withColumn(FAILED_RULES, mask).drop(MISSING)


def clean_split(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Silver rows and rejected ones from one scan, told apart by ``failed_rules``.

    Rejected rows go through the de-duplication with a key of their own, so that all of them
    stay, and after the last shuffle both kinds can be written together.
    """
    judged = judge(df, spec)
    if not spec.dedup_keys:
        return judged
    own = F.when(F.col(FAILED_RULES) != 0, F.monotonically_increasing_id())
    keyed = judged.withColumn(REJECT, own)
    return dedup(keyed, [*spec.dedup_keys, REJECT], spec.dedup_order).drop(REJECT)


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Append by column name, keeping duplicates."""
    return reduce(lambda a, b: a.unionByName(b), rest, first)
