"""Building a flow from a plain nested mapping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from trilode.functions.column_text import as_sql
from trilode.spec import (
    AggSpec,
    CleaningSpec,
    DatabaseSource,
    EventSource,
    FileSource,
    FlowSpec,
    GroupSpec,
    IncrementSpec,
    MetricSpec,
    Output,
    RuleSpec,
    SinkSpec,
    Source,
)

# The keys and words a config mapping uses, and the defaults of the source blocks below.
REQUIRED = (
    "business_domain", "bronze_table_name", "silver_table_name", "gold_table_name",
    "cleaning_rules", "aggregations",
)
SOURCE_TYPES = ("file", "event", "database")
EVENT_MODES = ("stream", "prefix")
GOLD_FORMATS = ("parquet", "orc", "csv", "json", "bigquery")
SOURCE_KEYS = (
    "type", "environment", "format", "path", "options", "s3_bucket", "s3_prefix", "s3_suffix",
    "event_type", "gcs_bucket", "gcs_prefix", "gcs_suffix", "pubsub_topic", "database",
    "mode", "max_files_per_trigger", "archive_dir", "after_reset",
)
DATABASE_KEYS = (
    "connection", "query", "incremental", "batch_size", "name", "partition_column",
    "num_partitions", "lower_bound", "upper_bound",
)
CLEANING_KEYS = (
    "null_drop_columns", "null_fill_columns", "deduplication_columns", "deduplication_order",
    "validation_rules", "data_type_fixes",
)
OUTPUT_KEYS = (
    "type", "expression", "alias", "description", "aggregations", "group_by", "date_column",
    "grain", "sort",
)
ENVIRONMENTS = ("offline", "aws", "gcp")

# Per environment: URI scheme and the prefix of the bucket keys.
BUCKETS = {"aws": ("s3", "s3"), "gcp": ("gs", "gcs")}

_FIELD = re.compile(r"^\s*(\w+)\s*:\s*([A-Za-z]+(?:\s*\(\s*\d+\s*,\s*\d+\s*\))?)")


def schema_ddl(text: str) -> str:
    """``name: type`` lines as a DDL schema; a note after the type is ignored."""
    fields = [m.groups() for m in map(_FIELD.match, text.splitlines()) if m]
    if not fields:
        raise ValueError("the schema text has no 'name: type' line")
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)


def flow_from_config(
    config: Mapping[str, Any],
    overrides: Mapping[str, Any] | None = None,
    root: str | None = None,
    declare_schema: bool = True,
) -> FlowSpec:
    """Overrides replace whole top-level blocks. Expressions are Columns, Spark SQL strings or column
    text in Python notation, which is translated and never evaluated.

    ``root`` defaults to ``data`` offline and to the source bucket in a cloud environment. The
    schema text is needed by streams; file sources use it as well and skip the inference pass,
    unless ``declare_schema`` is off. An event source streams unless its ``mode`` is ``prefix``, which
    appends the whole prefix on every run. Unknown keys and formats are errors.
    """
    config = {**config, **(overrides or {})}
    missing = [key for key in REQUIRED if key not in config]
    if missing:
        raise ValueError(f"missing config fields {missing}")
    block = config.get("source") or {
        "type": "file",
        "format": config.get("source_format", "csv"),
        "path": config.get("source_path", "data/raw/"),
        "options": config.get("source_options", {}),
    }
    known("source", block, SOURCE_KEYS)
    environment = block.get("environment", "offline")
    if environment not in ENVIRONMENTS:
        raise ValueError(f"unknown environment {environment!r}, expected one of {ENVIRONMENTS}")
    return FlowSpec(
        domain=config["business_domain"],
        root=root or _root(block, environment),
        bronze_table=config["bronze_table_name"],
        silver_table=config["silver_table_name"],
        gold_table=config["gold_table_name"],
        source=_source(
            block, environment, config.get("schema_info"), declare_schema,
            config["bronze_table_name"],
        ),
        cleaning=_cleaning(config["cleaning_rules"]),
        outputs=[_output(name, o) for name, o in config["aggregations"].items()],
        columns=tuple(config.get("available_columns", ())),
        gold_sink=_gold_sink(config),
        fuse=config.get("fuse", True),
        quarantine=config.get("quarantine", False),
    )


def _root(block: Mapping[str, Any], environment: str) -> str:
    if environment == "offline":
        return "data"
    scheme, prefix = BUCKETS[environment]
    if not block.get(f"{prefix}_bucket"):
        raise ValueError(f"environment {environment!r} needs {prefix}_bucket or a root")
    return f"{scheme}://{block[f'{prefix}_bucket']}"


def _source(
    block: Mapping[str, Any], environment: str, schema_info: str | None, declare_schema: bool,
    name: str,
) -> Source:
    kind = block.get("type", "file")
    if kind not in SOURCE_TYPES:
        raise ValueError(f"unknown source type {kind!r}, expected one of {SOURCE_TYPES}")
    if kind == "database":
        return _database(block.get("database", {}), name)
    common = {
        "format": block.get("format", "csv"),
        "options": dict(block.get("options", {"header": "true", "inferSchema": "true"})),
    }
    schema = schema_ddl(schema_info) if schema_info else None
    if kind == "file":
        declared = schema if declare_schema else None
        return FileSource(path=block.get("path", "data/raw/"), schema=declared, **common)
    landing = {"path": block.get("path", "data/raw/"), "suffix": None, "track_file": False}
    if environment != "offline":
        scheme, prefix = BUCKETS[environment]
        lost = [k for k in (f"{prefix}_bucket", f"{prefix}_prefix") if k not in block]
        if lost:
            raise ValueError(f"event source lacks {lost}")
        landing = {
            "path": f"{scheme}://{block[f'{prefix}_bucket']}/{block[f'{prefix}_prefix']}",
            "suffix": block.get(f"{prefix}_suffix"),
            "track_file": True,
        }
    mode = block.get("mode", "stream")
    if mode not in EVENT_MODES:
        raise ValueError(f"unknown event mode {mode!r}, expected one of {EVENT_MODES}")
    return EventSource(
        **landing, **common, schema=schema, streaming=mode == "stream",
        max_files_per_trigger=block.get("max_files_per_trigger"),
        archive_dir=block.get("archive_dir"),
        after_reset=block.get("after_reset", "refuse"),
    )


def known(what: str, block: Mapping[str, Any], keys: Sequence[str]) -> None:
    if lost := sorted(set(block) - set(keys)):
        raise ValueError(f"unknown keys {lost} in {what}, expected some of {sorted(keys)}")


def _database(block: Mapping[str, Any], name: str) -> DatabaseSource:
    known("database", block, DATABASE_KEYS)
    lost = [k for k in ("connection", "query") if k not in block]
    if lost:
        raise ValueError(f"database source lacks {lost}")
    link = block["connection"]
    step = block.get("incremental", {})
    return DatabaseSource(
        query=block["query"],
        name=block.get("name", name),
        partition_column=block.get("partition_column"),
        num_partitions=block.get("num_partitions", 1),
        lower_bound=_text(block.get("lower_bound")),
        upper_bound=_text(block.get("upper_bound")),
        url=link.get("url", ""),
        user=link.get("user", ""),
        password=link.get("password", ""),
        driver=link.get("driver", "org.postgresql.Driver"),
        fetch_size=block.get("batch_size", 10_000),
        increment=IncrementSpec(step["column"], step.get("last_value_table", "control_table"))
        if step.get("enabled")
        else None,
    )


def _text(value: Any) -> str | None:
    return None if value is None else str(value)


def _cleaning(block: Mapping[str, Any]) -> CleaningSpec:
    known("cleaning_rules", block, CLEANING_KEYS)
    return CleaningSpec(
        type_fixes={c: as_sql(e) for c, e in block.get("data_type_fixes", {}).items()},
        null_drop=tuple(block.get("null_drop_columns", ())),
        null_fill=dict(block.get("null_fill_columns", {})),
        rules=tuple(
            RuleSpec(r["column"], as_sql(r["rule"]), r.get("description", ""))
            for r in block.get("validation_rules", ())
        ),
        dedup_keys=tuple(block.get("deduplication_columns", ())),
        dedup_order=tuple(block.get("deduplication_order", ())),
    )


def _output(name: str, block: Mapping[str, Any]) -> Output:
    known(f"aggregation {name!r}", block, OUTPUT_KEYS)
    kind = block.get("type", "agg")
    if kind == "agg":
        return MetricSpec(name, as_sql(block["expression"]), block["alias"])
    if kind != "group_by":
        raise ValueError(f"unknown aggregation type {kind!r} in {name!r}")
    return GroupSpec(
        name,
        aggregates=[AggSpec(**a) for a in block["aggregations"]],
        group_by=tuple(block.get("group_by", ())),
        date_column=block.get("date_column"),
        grain=block.get("grain", "day"),
        sort=tuple(block.get("sort", ())),
    )


def _gold_sink(config: Mapping[str, Any]) -> SinkSpec:
    format = config.get("gold_output_format", "parquet")
    if format not in GOLD_FORMATS:
        raise ValueError(f"unknown gold_output_format {format!r}, expected one of {GOLD_FORMATS}")
    warehouse = config.get("gcp", {}).get("warehouse", {})
    layout = warehouse.get("partitioning", {})
    laid_out = {
        "format": format,
        "partition_by": (layout["field"],) if layout.get("enabled") else (),
        "partition_type": layout.get("type", "DAY"),
        "cluster_by": tuple(warehouse.get("clustering", ())),
    }
    if format != "bigquery":
        return SinkSpec(**laid_out)
    if lost := [k for k in ("project", "dataset") if k not in warehouse]:
        raise ValueError(f"the warehouse block lacks {lost}")
    return SinkSpec(
        **laid_out,
        table=f"{warehouse['project']}.{warehouse['dataset']}",
        mode=warehouse.get("write_disposition", "WRITE_TRUNCATE"),
    )
