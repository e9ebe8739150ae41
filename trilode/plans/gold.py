"""Writing the Gold outputs of a flow with as few passes over Silver as possible."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.operators.aggregate import (
    OUTPUT,
    fused_groups,
    group_table,
    metric_table,
    metrics,
    rows_of,
)
from trilode.sinks.write import (
    FILE_FORMATS,
    entries,
    remove,
    save_mode,
    swap_all,
    write_table,
    written_rows,
)
from trilode.sources.control import CONTROL_SCHEMA, last_mark, newest_mark, write_mark
from trilode.sources.files import read_layer
from trilode.spec import FlowSpec, GroupSpec, SinkSpec


T = TypeVar("T")

MAX_CONCURRENT_JOBS = 8


def output_sink(flow: FlowSpec, name: str, columns: Sequence[str]) -> SinkSpec:
    """The flow's Gold sink for one output, with the layout columns that output has."""
    sink = flow.gold_sink
    target = {"path": flow.gold_path(name)}
    if sink.table:
        target = {"path": None, "table": f"{sink.table}.{name}"}
    return replace(
        sink,
        **target,
        partition_by=[c for c in sink.partition_by if c in columns],
        cluster_by=[c for c in sink.cluster_by if c in columns],
    )


def write_gold(df: DataFrame, flow: FlowSpec) -> dict[str, int]:
    """Write every output; returns rows per output.

    Silver is scanned once for all scalar metrics and once for all grouped outputs. The two
    results are staged as small tables, from which the outputs are written. Jobs that do not
    depend on each other are submitted together, so that short ones fill idle executors.
    """
    spark = df.sparkSession
    # a folder per run, so that runs of one flow do not overwrite each other's staging
    staging, run_id = flow.staging_path(flow.gold_table), uuid.uuid4().hex
    sink = flow.gold_sink
    whole = not sink.table and sink.format in FILE_FORMATS and save_mode(sink.mode) == "overwrite"
    made = run_folder(flow, run_id) if flow.publish else f"{staging}/outputs"
    try:
        metric_part, group_part = _together(
            spark, [lambda: _metric_tables(df, flow, staging),
                    lambda: _group_tables(df, flow, staging)]
        )
        tables = {**metric_part, **group_part}

        def save(name: str) -> int:
            target = output_sink(flow, name, tables[name].columns)
            if whole:
                target = replace(target, path=f"{made}/{name}")
            return written_rows(tables[name], target)

        names = [o.name for o in flow.outputs]
        counts = dict(zip(names, _together(spark, [partial(save, name) for name in names])))
        if flow.publish:
            publish(spark, flow, run_id)
        elif whole:
            swap_all(spark, [(f"{made}/{name}", flow.gold_path(name)) for name in names])
        return counts
    except BaseException:
        if flow.publish:
            remove(spark, made)  # nobody reads a run that was not published
        raise
    finally:
        remove(spark, staging)


# ---------------------------------------------------------------- publication


PUBLISHED = "published"


def run_folder(flow: FlowSpec, run_id: str) -> str:
    return flow.gold_path("runs") + f"/{run_id}"


def publish(spark: SparkSession, flow: FlowSpec, run_id: str) -> None:
    """Move all readers to the outputs of a run, by one row in a log; then remove old runs.

    Published runs beyond the newest ``keep_runs`` go. Folders of runs that were never published are
    left alone, as they may be still writing.
    """
    log = flow.publications_path
    before = newest_mark(spark, log, flow.gold_table, PUBLISHED)
    write_mark(spark, log, flow.gold_table, PUBLISHED, run_id, load_number=before.loads)
    there = entries(spark, flow.gold_path("runs"))
    ours = (F.col("source") == flow.gold_table) & F.col("last_value").isin(there)
    newest = spark.read.schema(CONTROL_SCHEMA).parquet(log).where(ours).orderBy(
        F.desc("load_number"), F.desc("updated_at"))
    for row in newest.offset(flow.keep_runs).select("last_value").collect():
        remove(spark, run_folder(flow, row.last_value))


def published_run(spark: SparkSession, flow: FlowSpec) -> str | None:
    return last_mark(spark, flow.publications_path, flow.gold_table, PUBLISHED)


def read_outputs(
    spark: SparkSession, flow: FlowSpec, names: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """Gold outputs by name, all of the same run where runs are published."""
    names = [o.name for o in flow.outputs] if names is None else names
    if flow.gold_sink.table:
        return {name: spark.table(f"{flow.gold_sink.table}.{name}") for name in names}
    if not flow.publish:
        return {name: read_layer(spark, flow.gold_path(name)) for name in names}
    run_id = published_run(spark, flow)
    if run_id is None:
        raise ValueError(f"no run of {flow.gold_table} is published")
    return {name: read_layer(spark, f"{run_folder(flow, run_id)}/{name}") for name in names}


def read_output(spark: SparkSession, flow: FlowSpec, name: str) -> DataFrame:
    return read_outputs(spark, flow, [name])[name]


def _together(spark: SparkSession, jobs: Sequence[Callable[[], T]]) -> list[T]:
    """Submit Spark jobs from several driver threads; the first failure is raised."""
    if not jobs:
        return []
    with ThreadPoolExecutor(max_workers=min(len(jobs), MAX_CONCURRENT_JOBS)) as pool:
        inherit = inheritable_thread_target(spark)
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]


def _stage(df: DataFrame, path: str, split_by: Sequence[str] = ()) -> DataFrame:
    write_table(df, SinkSpec(path=path, partition_by=split_by))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _metric_tables(df: DataFrame, flow: FlowSpec, staging: str) -> dict[str, DataFrame]:
    if len(flow.metrics) < 2:
        return {m.name: metric_table(df, m) for m in flow.metrics}
    row = _stage(metrics(df, flow.metrics), f"{staging}/metrics")
    return {m.name: row.select(F.col(m.name).alias(m.alias)) for m in flow.metrics}


def fusable(groups: Sequence[GroupSpec]) -> bool:
    """Grouping sets read the input's own columns, not the derived time column of one output."""
    derived = {g.time_key for g in groups if g.date_column}
    used = {a.column for g in groups for a in g.aggregates}
    used |= {c for g in groups if not g.date_column for c in g.group_by}
    return len(groups) > 1 and not (derived & used)


def _group_tables(df: DataFrame, flow: FlowSpec, staging: str) -> dict[str, DataFrame]:
    groups = flow.groups
    if not (flow.fuse and fusable(groups)):
        return {g.name: group_table(df, g) for g in groups}
    fused = _stage(fused_groups(df, groups), f"{staging}/groups", [OUTPUT])
    return {g.name: rows_of(fused, groups, g) for g in groups}
