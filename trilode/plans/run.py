"""Bronze -> Silver -> Gold, with a Parquet table between layers and an audit row per layer."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.operators.audit import audit_row
from trilode.operators.clean import (
    FAILED_RULES,
    clean,
    clean_split,
    drop_nulls,
    fill_nulls,
    fix_types,
    require_columns,
)
from trilode.operators.quality import (
    CONTRACT,
    bronze_contract,
    gold_contract,
    rejected_report,
    rule_report,
    silver_contract,
)
from trilode.plans.gold import read_outputs, write_gold
from trilode.sinks.log import append_log
from trilode.sinks.split import split_rows
from trilode.sinks.write import entries, replaced_rows, written_rows
from trilode.sources.files import RESCUED, read_files, read_layer
from trilode.sources.lineage import with_lineage
from trilode.sources.queries import LOADED_AFTER, load_increment, load_query, read_increments
from trilode.spec import LAYERS, CatalogSource, EventSource, FlowSpec, SinkSpec, Source, layer_path
from trilode.streaming.ingest import BATCH_ID, EPOCH, load_arrivals, read_arrivals


@dataclass(frozen=True)
class LayerResult:
    layer: str
    success: bool
    seconds: float
    output_path: str
    input_rows: int | None = None
    output_rows: int | None = None
    error: str | None = None


def load_kind(source: Source) -> str:
    if isinstance(source, CatalogSource) and source.increment:
        return "increments"
    return "stream" if isinstance(source, EventSource) and source.streaming else "files"


def same_kind(spark: SparkSession, out: str, source: Source) -> None:
    """Refuse a Bronze folder that another kind of load has written: rows would be hidden, or
    loaded twice."""
    marks = {EPOCH: "stream", BATCH_ID: "stream", LOADED_AFTER: "increments"}
    found = {marks.get(name.partition("=")[0], "files") for name in entries(spark, out)}
    wanted = load_kind(source)
    if found - {wanted}:
        raise ValueError(f"Bronze at {out} holds {sorted(found)}, this source would add {wanted}")


def run_bronze(spark: SparkSession, flow: FlowSpec) -> tuple[int, int]:
    source, out = flow.source, flow.bronze_path
    same_kind(spark, out, source)
    if isinstance(source, CatalogSource):
        if source.increment:
            control = layer_path(flow.root, "control", source.increment.control_table)
            rows = load_increment(spark, replace(source, name=flow.bronze_table), control, out)
        else:
            rows = load_query(spark, source, out)
    elif isinstance(source, EventSource) and source.streaming:
        rows = load_arrivals(spark, source, out, flow.checkpoint_path, rescued=flow.rescued_path)
    else:
        mode = "append" if isinstance(source, EventSource) else "overwrite"
        sink = SinkSpec(path=out, mode=mode, options={"compression": "snappy"})
        landed = with_lineage(read_files(spark, source), source)
        staging = flow.staging_path(flow.bronze_table)
        if source.rescue:
            fit, misfit = split_rows(
                landed, F.col(RESCUED).isNull(), out, flow.rescued_path, staging)
            return fit + misfit, fit
        rows = written_rows(landed, sink) if mode == "append" else replaced_rows(
            landed, sink, staging)
    return rows, rows


def read_bronze(spark: SparkSession, flow: FlowSpec) -> DataFrame:
    if isinstance(flow.source, EventSource) and flow.source.streaming:
        return read_arrivals(spark, flow.source, flow.bronze_path)
    if load_kind(flow.source) == "increments":
        return read_increments(spark, flow.bronze_path)
    bronze = read_layer(spark, flow.bronze_path)
    return bronze.drop(RESCUED) if getattr(flow.source, "rescue", False) else bronze


def read_rescued(spark: SparkSession, flow: FlowSpec) -> DataFrame:
    """Lines that did not fit the schema, as text, with what could be read of them."""
    return read_layer(spark, flow.rescued_path).drop(EPOCH, BATCH_ID)


def run_silver(spark: SparkSession, flow: FlowSpec) -> tuple[int, int]:
    bronze = require_columns(read_bronze(spark, flow), flow.columns)
    if flow.quarantine:
        return bronze.count(), write_split(spark, flow, bronze)
    written = replaced_rows(clean(bronze, flow.cleaning), SinkSpec(path=flow.silver_path),
                            flow.staging_path(flow.silver_table))
    return bronze.count(), written


def write_split(spark: SparkSession, flow: FlowSpec, bronze: DataFrame) -> int:
    """Silver and its rejected rows in one write; returns the rows of Silver."""
    kept, _ = split_rows(
        clean_split(bronze, flow.cleaning), F.col(FAILED_RULES) == 0, flow.silver_path,
        flow.quarantine_path, flow.staging_path(flow.silver_table))
    return kept


def run_gold(spark: SparkSession, flow: FlowSpec) -> tuple[int, int]:
    silver = read_layer(spark, flow.silver_path)
    return silver.count(), sum(write_gold(silver, flow).values())


_STEPS: dict[str, Callable[[SparkSession, FlowSpec], tuple[int, int]]] = {
    "bronze": run_bronze,
    "silver": run_silver,
    "gold": run_gold,
}


CHECKS = "run_id string, layer string, check_name string, violations bigint, passed boolean"


def layer_contract(spark: SparkSession, flow: FlowSpec, layer: str) -> DataFrame:
    """The contract of a layer that has just been written: ``(layer, check_name, violations, passed)``."""
    if layer == "bronze":
        return bronze_contract(read_bronze(spark, flow), flow.source)
    if layer == "silver":
        return silver_contract(read_layer(spark, flow.silver_path), flow.cleaning)
    if flow.gold_sink.format != "parquet":
        return spark.createDataFrame([], CONTRACT)
    return gold_contract(read_outputs(spark, flow), flow)


def store_checks(spark: SparkSession, flow: FlowSpec, layer: str, run_id: str) -> list[str]:
    """Keep a layer's contract, and with Silver the rule report of what went into it; the names of
    the checks that failed."""
    found = layer_contract(spark, flow, layer).select(
        F.lit(run_id).alias("run_id"), "layer", "check_name", "violations", "passed")
    append_log(found, flow.checks_path)
    if layer == "silver" and flow.cleaning.rules and flow.quarantine:
        rejected = read_layer(spark, flow.quarantine_path)
        rows = read_bronze(spark, flow).count()  # from footers
        report = rejected_report(rejected, flow.cleaning, rows)
        append_log(report.withColumn("run_id", F.lit(run_id)), flow.rules_path)
    elif layer == "silver" and flow.cleaning.rules:
        fixed = fix_types(read_bronze(spark, flow), flow.cleaning.type_fixes)
        fed = fill_nulls(drop_nulls(fixed, flow.cleaning.null_drop), flow.cleaning.null_fill)
        report = rule_report(fed, flow.cleaning.rules)
        append_log(report.withColumn("run_id", F.lit(run_id)), flow.rules_path)
    stored = spark.read.schema(CHECKS).parquet(flow.checks_path)
    failed = stored.where((F.col("run_id") == run_id) & (F.col("layer") == layer) & ~F.col("passed"))
    return [r.check_name for r in failed.select("check_name").collect()]


def _target(flow: FlowSpec, layer: str) -> str:
    if layer == "gold":
        return flow.gold_sink.table or flow.gold_path("")
    return flow.bronze_path if layer == "bronze" else flow.silver_path


def run(
    spark: SparkSession,
    flow: FlowSpec,
    layers: Sequence[str] = LAYERS,
    audit: bool = True,
    checks: bool = False,
    strict: bool = False,
) -> dict[str, LayerResult]:
    """Run the chosen layers in order and stop at the first that fails.

    Input counts are whole-table counts that Parquet answers from file footers; output counts are
    observed while writing. With ``checks`` each layer's contract and the rule report are stored
    with the run; with ``strict`` a broken contract fails its layer.
    """
    unknown = [name for name in layers if name not in LAYERS]
    if unknown:
        raise ValueError(f"unknown layers {unknown}, expected some of {LAYERS}")
    run_id = uuid.uuid4().hex
    results: dict[str, LayerResult] = {}
    for layer in [name for name in LAYERS if name in layers]:
        result, started = _timed(spark, flow, layer)
        if result.success and (checks or strict):
            broken = store_checks(spark, flow, layer, run_id)
            if broken and strict:
                result = replace(result, success=False, error=f"broken contract: {broken}")
        results[layer] = result
        if audit:
            row = (
                run_id, layer, result.success, result.seconds, result.input_rows,
                result.output_rows, result.output_path, result.error, started,
            )
            append_log(audit_row(spark, row), flow.audit_path)
        if not result.success:
            break
    return results


def _timed(spark: SparkSession, flow: FlowSpec, layer: str) -> tuple[LayerResult, datetime]:
    started, clock = datetime.now(timezone.utc), time.monotonic()
    read = written = error = None
    try:
        read, written = _STEPS[layer](spark, flow)
    except Exception as failure:  # the outcome of a layer is data, whatever went wrong in it
        error = f"{type(failure).__name__}: {failure}"
    seconds = time.monotonic() - clock
    return (
        LayerResult(layer, error is None, seconds, _target(flow, layer), read, written, error),
        started,
    )
