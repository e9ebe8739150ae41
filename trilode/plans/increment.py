"""Silver and Gold by increment: only new Bronze batches are cleaned, only they are aggregated.

Silver lies in buckets of its de-duplication key. The rows that a step adds are stored first (the
delta), with a number of the step; then they go into Silver, and their partial aggregates into Gold.
Every part can be repeated: a step that died is finished from its delta by the next call.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trilode.functions.exprs import order_column, sort_columns
from trilode.operators.aggregate import time_column
from trilode.operators.clean import clean, require_columns
from trilode.plans.run import load_kind
from trilode.sinks.write import entries, remove, swap_in, write_table
from trilode.sources.control import newest_mark
from trilode.sources.files import ensure_table
from trilode.sources.queries import LOAD_NUMBER, LOADED_AFTER, read_increments
from trilode.spec import FlowSpec, GroupSpec, MetricSpec, Output, SinkSpec, layer_path
from trilode.streaming.ingest import BATCH_ID, EPOCH, read_arrivals, stored_epochs

BUCKET = "bucket"
STEP = "step"
HELD = "__held"
PLACE = "__place"
BUCKETS = 64

# Aggregates whose partial results can be put together, and how.
MERGES = {"sum": ("sum",), "count": ("sum",), "min": ("min",), "max": ("max",), "avg": ("sum", "count")}
_CALL = re.compile(r"\s*(sum|count|min|max|avg)\s*\(((?:[^()]|\([^()]*\))*)\)\s*", re.IGNORECASE)
_INNER = re.compile(r"\b(sum|count|min|max|avg|count_if|distinct)\b", re.IGNORECASE)


@dataclass(frozen=True)
class Step:
    """What a step did: its number, the rows that are new in Silver, and the buckets rewritten."""

    number: int
    added: int
    rewritten: tuple[int, ...] = ()


def _folders(flow: FlowSpec) -> tuple[str, str]:
    base = layer_path(flow.root, "control", f"{flow.silver_table}_steps")
    return f"{base}deltas", f"{base}done"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


DONE = f"{STEP} bigint, epoch string, upto bigint"


def _new_batches(spark: SparkSession, flow: FlowSpec, done: str) -> tuple[DataFrame, dict[str, int]]:
    """Rows of the Bronze batches that no finished step has taken, and the last batch of each epoch.

    Batches of a checkpoint, and committed loads of an incremental source, come in the order of
    their numbers, so one number says which have been taken. Only folder names of old batches are
    looked at.
    """
    state = spark.read.schema(DONE).parquet(done).groupBy("epoch").agg(F.max("upto").alias("upto"))
    taken = {r.epoch: r.upto for r in state.collect()}  # a row per checkpoint there has been
    kind, source, bronze = load_kind(flow.source), flow.source, flow.bronze_path
    if kind == "increments":
        control = layer_path(flow.root, "control", source.increment.control_table)
        last = newest_mark(spark, control, flow.bronze_table, source.increment.column).loads - 1
        number = F.coalesce(F.col(LOAD_NUMBER), F.lit(0))
        wanted = (number > taken.get("", -1)) & (number <= last)
        fresh = {"": last} if last > taken.get("", -1) else {}
        rows = read_increments(spark, bronze)
        return rows.where(wanted).drop(LOADED_AFTER, LOAD_NUMBER), fresh
    if kind != "stream":
        raise ValueError("only a stream or an incremental source tells new rows from old ones")
    fresh, wanted = {}, F.lit(False)
    for epoch in sorted(stored_epochs(spark, bronze)):
        names = [n.partition("=")[2] for n in entries(spark, f"{bronze.rstrip('/')}/{EPOCH}={epoch}")]
        last = max((int(n) for n in names if n.isdigit()), default=-1)
        if last > taken.get(epoch, -1):
            fresh[epoch] = last
            batch = F.col(BATCH_ID)
            wanted = wanted | ((F.col(EPOCH) == epoch) & (batch > taken.get(epoch, -1))
                               & (batch <= last))
    rows = read_arrivals(spark, source, bronze, parts=True)
    return rows.where(wanted).drop(EPOCH, BATCH_ID), fresh


def _delta(spark: SparkSession, flow: FlowSpec, new: DataFrame) -> DataFrame:
    """Of the cleaned rows, those that Silver does not hold or that come before what it holds of
    their key.

    ``replaces`` marks the latter. Where the flow has no order, a held row always stays.
    """
    spec, keys = flow.cleaning, list(flow.cleaning.dedup_keys)
    if not keys or not entries(spark, flow.silver_path):
        return new.withColumn("replaces", F.lit(False))
    silver = _touched(spark, flow, new)
    if not spec.dedup_order:
        return _unknown(new, silver, keys).withColumn("replaces", F.lit(False))
    both = silver.withColumn(HELD, F.lit(1)).unionByName(new.withColumn(HELD, F.lit(0)))
    same_key = Window.partitionBy(*keys)  # at most a held and a new row
    order = [*[order_column(o) for o in spec.dedup_order], F.desc(HELD)]
    ranked = both.withColumns({
        PLACE: F.row_number().over(same_key.orderBy(*order)),
        "replaces": F.max(HELD).over(same_key) == 1})
    return ranked.where((F.col(PLACE) == 1) & (F.col(HELD) == 0)).drop(PLACE, HELD)


def _touched(spark: SparkSession, flow: FlowSpec, new: DataFrame) -> DataFrame:
    """The buckets of Silver in which the new rows' keys can be."""
    buckets = [r[0] for r in new.select(BUCKET).distinct().collect()]  # at most all buckets
    return spark.read.parquet(flow.silver_path).where(F.col(BUCKET).isin(buckets))


def _unknown(new: DataFrame, silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    held = silver.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    same = [new[k].eqNullSafe(held[f"__k{i}"]) for i, k in enumerate(keys)]
    return new.join(held, reduce(lambda a, b: a & b, same), "left_anti")


def _into_silver(
    spark: SparkSession, flow: FlowSpec, delta: DataFrame, number: int, again: bool
) -> tuple[int, ...]:
    """Append what is new; rewrite the buckets in which a held row makes room for another."""
    keys = list(flow.cleaning.dedup_keys)
    sink = SinkSpec(
        path=flow.silver_path, partition_by=(BUCKET,) if keys else (STEP,), rebalance=bool(keys),
        options={"partitionOverwriteMode": "dynamic"})
    rows = delta.drop("replaces")
    if not entries(spark, flow.silver_path):
        part = f"{BUCKET}=0" if keys else f"{STEP}={number}"
        ensure_table(spark, f"{flow.silver_path}{part}", rows.drop(BUCKET).schema)
    if not keys:  # a step is a partition of its own, so a repeated one replaces itself
        write_table(rows.drop(BUCKET).withColumn(STEP, F.lit(number)), sink)
        return ()
    rewritten = tuple(sorted(
        r[0] for r in delta.where("replaces").select(BUCKET).distinct().collect()))
    if rewritten:
        held = spark.read.parquet(flow.silver_path).where(F.col(BUCKET).isin(*rewritten))
        mine = rows.where(F.col(BUCKET).isin(*rewritten))
        write_table(_unknown(held, mine, keys).unionByName(mine), sink)
        rows = rows.where(~F.col(BUCKET).isin(*rewritten))
    if again:  # a step that died may have appended some of its rows
        rows = _unknown(rows, _touched(spark, flow, rows), keys)
    write_table(rows, replace(sink, mode="append", options={}))
    return rewritten


# ---------------------------------------------------------------- Gold


def _parts(function: str) -> tuple[str, ...]:
    if function.lower() not in MERGES:
        raise ValueError(f"{function} cannot be put together from parts; mergeable are {sorted(MERGES)}")
    return MERGES[function.lower()]


def _measures(output: Output) -> dict[str, tuple[str, str]]:
    """``alias -> (function, argument)`` of an output; an error for what does not merge."""
    if isinstance(output, GroupSpec):
        found = {a.alias: (a.function.lower(), a.column) for a in output.aggregates}
    else:
        text = output.expression if isinstance(output.expression, str) else ""
        call = _CALL.fullmatch(text)
        if not call or _INNER.search(call[2]):
            raise ValueError(f"metric {output.name!r} is not one of {sorted(MERGES)} over an expression")
        found = {output.alias: (call[1].lower(), call[2].strip())}
    for function, _ in found.values():
        _parts(function)
    return found


def _partial(df: DataFrame, output: Output) -> DataFrame:
    """The partial states of one output: a column per alias and part."""
    keys = list(output.keys) if isinstance(output, GroupSpec) else []
    if keys and output.date_column:
        df = df.withColumn(output.time_key, time_column(df, output))
    states = []
    for alias, (function, argument) in _measures(output).items():
        grouped = isinstance(output, GroupSpec) and argument != "*"
        value = F.lit(1) if argument == "*" else F.col(argument) if grouped else F.expr(argument)
        for i, part in enumerate(_parts(function)):
            made = F.count(value) if function == "count" or part == "count" else F.call_function(part, value)
            states.append(made.alias(f"{alias}__{i}"))
    return df.groupBy(*keys).agg(*states)


def _state_path(flow: FlowSpec, name: str) -> str:
    return f"{layer_path(flow.root, 'gold', f'{flow.gold_table}_states')}{name}"


def read_gold(spark: SparkSession, flow: FlowSpec, name: str) -> DataFrame:
    """An output of the flow, put together from the partial states of all steps."""
    output = next(o for o in flow.outputs if o.name == name)
    keys = list(output.keys) if isinstance(output, GroupSpec) else []
    states = spark.read.parquet(_state_path(flow, name))
    merged = []
    for alias, (function, _) in _measures(output).items():
        if function == "avg":
            total, count = F.sum(f"{alias}__0"), F.sum(f"{alias}__1")
            value = F.try_divide(total, count)
        else:
            value = F.call_function(_parts(function)[0], F.col(f"{alias}__0"))
            if function == "count":
                value = F.coalesce(value, F.lit(0))
        merged.append(value.alias(alias))
    out = states.groupBy(*keys).agg(*merged)
    sort = output.sort if isinstance(output, GroupSpec) else ()
    return out.orderBy(*sort_columns(sort)) if sort else out


def check_mergeable(flow: FlowSpec) -> None:
    """Refuse a flow whose Gold could not be kept by adding to it."""
    if flow.outputs and flow.cleaning.dedup_order:
        raise ValueError("rows that replace others cannot be added to aggregates: leave out dedup_order")
    for output in flow.outputs:
        _measures(output)


# ---------------------------------------------------------------- steps


def run_increment(spark: SparkSession, flow: FlowSpec, buckets: int = BUCKETS) -> Step:
    """Take the Bronze batches that have come since the last step into Silver and Gold.

    Old batches are not read. Of Silver, the key columns in the buckets of new keys are read, and
    rewritten are the buckets in which a row is replaced (with ``dedup_order``). ``buckets`` must
    stay as it was in the first step. The outputs are kept as partial states of each step
    (:func:`read_gold`).
    """
    check_mergeable(flow)
    deltas, done = _folders(flow)
    ensure_table(spark, done, DONE)
    finished = spark.read.schema(DONE).parquet(done).agg(F.max(STEP)).first()[0]
    number = 0 if finished is None else finished + 1
    place, batches = f"{deltas}/{number}", f"{deltas}/{number}-batches"
    again = bool(entries(spark, place))
    if not again:
        rows, fresh = _new_batches(spark, flow, done)
        if not fresh:
            return Step(number, 0)
        keys = flow.cleaning.dedup_keys
        new = clean(require_columns(rows, flow.columns), flow.cleaning)
        write_table(new.withColumn(BUCKET, _bucket(keys, buckets) if keys else F.lit(0)),
                    SinkSpec(path=f"{place}-new"))
        cleaned = spark.read.parquet(f"{place}-new")
        write_table(spark.createDataFrame(list(fresh.items()), "epoch string, upto bigint"),
                    SinkSpec(path=batches))
        # in place only when whole, so a delta that is there can be relied on
        write_table(_delta(spark, flow, cleaned), SinkSpec(path=f"{place}-unfinished"))
        swap_in(spark, f"{place}-unfinished", place)
    delta = spark.read.parquet(place)
    rewritten = _into_silver(spark, flow, delta, number, again)
    for output in flow.outputs:
        sink = SinkSpec(path=_state_path(flow, output.name), partition_by=(STEP,), rebalance=False,
                        options={"partitionOverwriteMode": "dynamic"})
        write_table(_partial(delta, output).withColumn(STEP, F.lit(number)), sink)
    added = delta.count()  # from footers
    taken = spark.read.schema("epoch string, upto bigint").parquet(batches)
    write_table(taken.select(F.lit(number).cast("bigint").alias(STEP), "epoch", "upto"),
                SinkSpec(path=done, mode="append"))
    for folder in (place, batches, f"{place}-new"):
        remove(spark, folder)
    return Step(number, added, rewritten)
