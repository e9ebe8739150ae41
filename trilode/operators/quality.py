"""Data-quality reports. Each is one pass with one aggregate, turned from columns into rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.functions.exprs import as_column
from trilode.operators.clean import (
    FAILED_RULES,
    KEY_HASH,
    fill_nulls,
    fix_types,
    has_column,
    present,
    type_of,
)
from trilode.sources.lineage import INGESTED_AT, lineage_column
from trilode.spec import CleaningSpec, FlowSpec, RuleSpec, Source


REPORT = "position int, column_name string, description string, failed bigint, total bigint"


def _fails(rule: RuleSpec) -> Column:
    return ~F.coalesce(as_column(rule.rule), F.lit(False))


def rule_report(df: DataFrame, rules: Sequence[RuleSpec]) -> DataFrame:
    """``(position, column_name, description, failed, total)`` per rule; a NULL outcome fails."""
    if not rules:
        return df.sparkSession.createDataFrame([], REPORT)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(_fails(r)).alias(f"failed_{i}") for i, r in enumerate(rules)],
    )
    return counts.select(F.inline(F.array(*_report_lines(rules))))


def _report_lines(rules: Sequence[RuleSpec]) -> list[Column]:
    return [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.description).alias("description"),
            F.col(f"failed_{i}").alias("failed"),
            F.col("total"),
        )
        for i, r in enumerate(rules)
    ]


def row_accounting(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Where the rows of a cleaning step went: ``(bronze, null_dropped, rule_failed, duplicates,
    silver)``; the middle three and ``silver`` add up to ``bronze``.

    Kept rows are counted per key on the map side first, so a hot key is one row per partition.
    """
    fixed = fix_types(df, spec.type_fixes)
    complete = F.lit(True)
    for column in spec.null_drop:
        complete = complete & present(fixed, column)
    filled = fill_nulls(fixed.withColumn("__complete", complete), spec.null_fill)
    valid = F.lit(True)
    for rule in spec.rules:
        valid = valid & ~_fails(rule)
    outcome = F.when(~F.col("__complete"), "null").when(valid, "kept").otherwise("rule")
    judged = filled.withColumn("__outcome", outcome)
    kept_key = [F.when(F.col("__outcome") == "kept", F.col(k)) for k in spec.dedup_keys]
    keyed = judged.groupBy(
        "__outcome", *[k.alias(f"__k{i}") for i, k in enumerate(kept_key)]
    ).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    kept = F.coalesce(F.sum(F.when(F.col("__outcome") == "kept", F.col("n"))), F.lit(0))
    distinct = F.count_if(F.col("__outcome") == "kept") if spec.dedup_keys else kept
    return keyed.agg(
        total.alias("bronze"),
        F.coalesce(F.sum(F.when(F.col("__outcome") == "null", F.col("n"))), F.lit(0))
        .alias("null_dropped"),
        F.coalesce(F.sum(F.when(F.col("__outcome") == "rule", F.col("n"))), F.lit(0))
        .alias("rule_failed"),
        (kept - distinct).alias("duplicates"),
        distinct.alias("silver"),
    )


# ---------------------------------------------------------------- layer contracts

CONTRACT = "layer string, check_name string, violations bigint, passed boolean"


def _checked(layer: str, counts: DataFrame, names: Sequence[str]) -> DataFrame:
    lines = [
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("check_name"),
            F.col(f"check_{i}").cast("bigint").alias("violations"),
            (F.col(f"check_{i}") == 0).alias("passed"),
        )
        for i, name in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*lines)))


def _schema_checks(df: DataFrame, layer: str, wanted: Sequence[str]) -> DataFrame:
    spark = df.sparkSession
    rows = [(layer, f"has {c}", int(not has_column(df, c)), has_column(df, c)) for c in wanted]
    return spark.createDataFrame(rows, CONTRACT)


def bronze_contract(df: DataFrame, source: Source) -> DataFrame:
    """Bronze carries the ingestion time and its origin. Looks at the schema only."""
    return _schema_checks(df, "bronze", (INGESTED_AT, lineage_column(source)))


def _by_key(df: DataFrame, keys: Sequence[str], flags: Sequence[Column] = ()) -> DataFrame:
    """``(__n, __flag_0, ...)`` per key: its rows, and those for which each flag holds.

    Shuffled are 128 bits of hash in place of the whole key; among a trillion keys the chance that
    two of them share these is below one in 10^14. Keys with a collation are compared themselves,
    as equal ones can have different bytes.
    """
    folded = [k for k in keys if "collate" in type_of(df, k).simpleString()]
    plain = [k for k in keys if k not in folded]
    hashes = [F.xxhash64(*plain), F.xxhash64(F.lit("second"), *plain)] if plain else []
    parts = {f"{KEY_HASH}{i}": h for i, h in enumerate([*hashes, *map(F.col, folded)])}
    named = [c.alias(n) for n, c in parts.items()]
    marks = [f.alias(f"__flag_{i}") for i, f in enumerate(flags)]
    return df.select(*named, *marks).groupBy(*parts).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count_if(f"__flag_{i}").alias(f"__flag_{i}") for i in range(len(flags))])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(repeats)``: rows beyond the first of their key, NULL parts being equal to each other."""
    return _by_key(df, keys).agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("repeats"))


def silver_contract(df: DataFrame, spec: CleaningSpec) -> DataFrame:
    """Silver has no NULL in a required column and no key twice. One pass over the data."""
    names = [f"no null {c}" for c in spec.null_drop]
    gaps = [~present(df, c) for c in spec.null_drop]
    if spec.dedup_keys:
        counts = _by_key(df, spec.dedup_keys, gaps).agg(
            *[F.coalesce(F.sum(f"__flag_{i}"), F.lit(0)).alias(f"check_{i}") for i in range(len(gaps))],
            F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias(f"check_{len(gaps)}"))
        return _checked("silver", counts, [*names, "unique key"])
    if not gaps:
        return df.sparkSession.createDataFrame([], CONTRACT)
    counts = df.agg(*[F.count_if(g).alias(f"check_{i}") for i, g in enumerate(gaps)])
    return _checked("silver", counts, names)


def rejected_report(rejected: DataFrame, spec: CleaningSpec, bronze_rows: int) -> DataFrame:
    """The rule report from the rows that were set aside, without another look at Bronze."""
    first_gap = F.lit(1 << len(spec.rules))
    counts = rejected.agg(
        (F.lit(bronze_rows) - F.count_if(F.col(FAILED_RULES) >= first_gap)).alias("total"),
        *[F.count_if(F.col(FAILED_RULES).bitwiseAND(F.lit(1 << i)) != 0).alias(f"failed_{i}")
          for i in range(len(spec.rules))],
    )
    return counts.select(F.inline(F.array(*_report_lines(spec.rules))))


def gold_contract(tables: Mapping[str, DataFrame], flow: FlowSpec) -> DataFrame:
    """Every declared output exists with its keys and aliases. Looks at schemas only."""
    promised = {m.name: [m.alias] for m in flow.metrics}
    promised.update({g.name: [*g.keys, *[a.alias for a in g.aggregates]] for g in flow.groups})
    found = []
    for name, wanted in promised.items():
        have = tables[name].columns if name in tables else []
        lost = [c for c in wanted if c not in have]
        found.append(("gold", f"{name} complete", len(lost), not lost))
    return SparkSession.active().createDataFrame(found, CONTRACT)
