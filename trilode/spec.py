"""Typed description of one flow: where rows come from, how they are cleaned, what is aggregated.

Every slot that holds logic takes a Spark SQL expression string or a ``Column``; nothing is
evaluated as Python text.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Union

from pyspark.sql import Column

Expr = Union[str, Column]

LAYERS = ("bronze", "silver", "gold")
FILE_FORMATS = ("csv", "json", "parquet")
GRAINS = ("day", "hour")
SPLITS = ("stride", "quantile")
AFTER_RESET = ("refuse", "add", "new_files")

# Aggregates whose state grows with the group: one hot group would end up whole in one task.
UNBOUNDED_AGGREGATES = frozenset(
    {"array_agg", "collect_list", "collect_set", "histogram_numeric", "listagg", "median",
     "mode", "percentile", "percentile_cont", "percentile_disc", "string_agg"}
)

_IDENTIFIER = re.compile(r"[A-Za-z_]\w*")


def layer_path(root: str, layer: str, table: str) -> str:
    """``<root>/<layer>/<table>/`` on any Hadoop filesystem URI."""
    return f"{root.rstrip('/')}/{layer}/{table}/"


# ---------------------------------------------------------------- sources


@dataclass(frozen=True)
class FileSource:
    """A file or directory scan. ``schema`` is a DDL string; giving it skips the inference pass.

    With ``rescue`` lines that do not fit the schema (CSV: a value that does not parse, too few or too
    many fields; JSON: a value that does not parse, broken text) go to a table of their own as text.
    """

    path: str
    format: str = "csv"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    suffix: str | None = None
    track_file: bool = False
    rescue: bool = field(default=False, kw_only=True)

    def __post_init__(self):
        if self.rescue and not (self.schema and self.format in ("csv", "json")):
            raise ValueError("rescue needs a declared schema and a text format")
        if not self.path:
            raise ValueError("a file source needs a path")
        if self.format not in FILE_FORMATS:
            raise ValueError(f"unknown file format {self.format!r}, expected one of {FILE_FORMATS}")


@dataclass(frozen=True)
class EventSource(FileSource):
    """A landing directory that keeps receiving files. Bronze holds each load in a partition of its
    own.

    ``streaming=True`` ingests each file exactly once through a checkpoint and needs ``schema``;
    ``streaming=False`` reads the whole prefix and appends it. With ``archive_dir`` the files of a
    batch are moved there once it is committed.

    ``after_reset`` says what happens when Bronze holds batches of another checkpoint, as after the
    loss of the old one: ``refuse``; ``add`` all that is in the landing; or ``new_files``, which
    leaves out rows of files that Bronze knows and needs ``track_file``.
    """

    streaming: bool = True
    max_files_per_trigger: int | None = None
    archive_dir: str | None = None
    after_reset: str = "refuse"

    def __post_init__(self):
        super().__post_init__()
        if self.streaming and not self.schema:
            raise ValueError("a streaming event source needs a declared schema")
        if self.rescue and not self.streaming:
            raise ValueError("rescue needs an event source that streams")
        if self.after_reset not in AFTER_RESET:
            raise ValueError(f"unknown after_reset {self.after_reset!r}, expected one of {AFTER_RESET}")
        if self.after_reset == "new_files" and not (self.track_file or self.archive_dir):
            raise ValueError("after_reset='new_files' needs track_file")


@dataclass(frozen=True)
class IncrementSpec:
    """Read only rows whose ``column`` lies past the last value kept in the control table."""

    column: str
    control_table: str = "control_table"


UNNAMED = "source"


@dataclass(frozen=True)
class CatalogSource:
    """A SQL query over temp views or catalog tables of the session.

    An incremental source keeps its mark under ``name``; in a flow that is the Bronze table.
    """

    query: str
    name: str = UNNAMED
    increment: IncrementSpec | None = None

    def __post_init__(self):
        if not self.query:
            raise ValueError("a query source needs a query")


@dataclass(frozen=True)
class DatabaseSource(CatalogSource):
    """A SQL query sent over JDBC.

    ``partition_column`` (number, date or timestamp) splits the read into ``num_partitions``
    range queries; without bounds they are asked from the database in one aggregate query.
    ``split="stride"`` makes ranges of equal width, ``split="quantile"`` ranges of about equally many
    rows, for a column whose values are uneven; the database then sorts that column once. A value is
    never split over readers, so a column with a very frequent value remains a poor choice.
    """

    url: str = ""
    user: str = ""
    password: str = field(default="", repr=False)
    driver: str = "org.postgresql.Driver"
    fetch_size: int = 10_000
    partition_column: str | None = None
    num_partitions: int = 1
    lower_bound: str | None = None
    upper_bound: str | None = None
    split: str = "stride"

    def __post_init__(self):
        super().__post_init__()
        if self.split not in SPLITS:
            raise ValueError(f"unknown split {self.split!r}, expected one of {SPLITS}")
        if self.num_partitions > 1 and not self.partition_column:
            raise ValueError("a parallel database read needs a partition_column")
        if (self.lower_bound is None) != (self.upper_bound is None):
            raise ValueError("give both bounds of the partition column or neither")


Source = Union[FileSource, CatalogSource]


# ---------------------------------------------------------------- cleaning


@dataclass(frozen=True)
class RuleSpec:
    """A predicate every Silver row must satisfy. A NULL outcome counts as a failure."""

    column: str
    rule: Expr
    description: str = ""


@dataclass(frozen=True)
class CleaningSpec:
    """Applied in this order: type fixes, null drop, null fill, rules, de-duplication."""

    type_fixes: Mapping[str, Expr] = field(default_factory=dict)
    null_drop: Sequence[str] = ()
    null_fill: Mapping[str, Expr] = field(default_factory=dict)
    rules: Sequence[RuleSpec] = ()
    dedup_keys: Sequence[str] = ()
    dedup_order: Sequence[Expr] = ()


# ---------------------------------------------------------------- aggregates


@dataclass(frozen=True)
class AggSpec:
    """``function(column) AS alias``; ``column="*"`` counts rows."""

    column: str
    function: str
    alias: str

    def __post_init__(self):
        if not _IDENTIFIER.fullmatch(self.function):
            raise ValueError(f"not an aggregate name: {self.function!r}")
        if self.function.lower() in UNBOUNDED_AGGREGATES:
            raise ValueError(f"{self.function} keeps a whole group in one task")


@dataclass(frozen=True)
class MetricSpec:
    """One global aggregate, stored as a one-row table ``name`` with the column ``alias``."""

    name: str
    expression: Expr
    alias: str


@dataclass(frozen=True)
class GroupSpec:
    """One grouped output table.

    With ``date_column`` the output is a trend over the derived ``date`` (or ``hour``) column and
    ``group_by`` plays no part.
    """

    name: str
    aggregates: Sequence[AggSpec]
    group_by: Sequence[str] = ()
    date_column: str | None = None
    grain: str = "day"
    sort: Sequence[str] = ()

    def __post_init__(self):
        if not self.aggregates:
            raise ValueError(f"grouped output {self.name!r} has no aggregates")
        if not self.group_by and not self.date_column:
            raise ValueError(f"grouped output {self.name!r} has no keys")
        if self.grain not in GRAINS:
            raise ValueError(f"unknown grain {self.grain!r}, expected one of {GRAINS}")

    @property
    def time_key(self) -> str:
        return "date" if self.grain == "day" else "hour"

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.time_key,) if self.date_column else tuple(self.group_by)


Output = Union[MetricSpec, GroupSpec]


# ---------------------------------------------------------------- sinks


@dataclass(frozen=True)
class SinkSpec:
    """Where a table goes. ``mode`` takes a Spark save mode or a warehouse write disposition.

    ``rebalance`` shuffles partitioned output once, for few files per partition value; leave it
    off when each task holds rows of few values anyway.
    """

    path: str | None = None
    table: str | None = None
    format: str = "parquet"
    mode: str = "overwrite"
    options: Mapping[str, str] = field(default_factory=dict)
    partition_by: Sequence[str] = ()
    partition_type: str = "DAY"
    rebalance: bool = True
    cluster_by: Sequence[str] = ()


@dataclass(frozen=True)
class FlowSpec:
    """A whole Bronze -> Silver -> Gold flow.

    ``fuse`` computes all grouped outputs in one pass over Silver; without it each output makes
    its own pass over the columns it needs. ``quarantine`` keeps the rows that Silver rejects in a
    table of their own, written in the same pass; both tables then have the column ``failed_rules``,
    which is 0 in Silver. ``publish`` keeps the Gold outputs of each run in a folder of the run, and
    moves the readers (``read_output``) from the last run to the new one in one step, for all outputs;
    ``keep_runs`` published runs stay, for readers that have begun.
    """

    domain: str
    root: str
    bronze_table: str
    silver_table: str
    gold_table: str
    source: Source
    cleaning: CleaningSpec = field(default_factory=CleaningSpec)
    outputs: Sequence[Output] = ()
    columns: Sequence[str] = ()
    gold_sink: SinkSpec = field(default_factory=SinkSpec)
    fuse: bool = True
    quarantine: bool = False
    publish: bool = False
    keep_runs: int = 2

    def __post_init__(self):
        sink = self.gold_sink
        if self.publish and (sink.table or sink.format != "parquet" or sink.mode != "overwrite"):
            raise ValueError("publish needs Gold outputs that are Parquet files and overwritten")
        if self.keep_runs < 1:
            raise ValueError("keep_runs must be at least 1")
        names = [o.name for o in self.outputs]
        doubled = sorted({n for n in names if names.count(n) > 1})
        if doubled:
            raise ValueError(f"output names used twice: {doubled}")

    def override(self, **changes) -> FlowSpec:
        """Shallow override: a given field replaces the whole block."""
        return replace(self, **changes)

    @property
    def metrics(self) -> list[MetricSpec]:
        return [o for o in self.outputs if isinstance(o, MetricSpec)]

    @property
    def groups(self) -> list[GroupSpec]:
        return [o for o in self.outputs if isinstance(o, GroupSpec)]

    @property
    def bronze_path(self) -> str:
        return layer_path(self.root, "bronze", self.bronze_table)

    @property
    def silver_path(self) -> str:
        return layer_path(self.root, "silver", self.silver_table)

    @property
    def quarantine_path(self) -> str:
        return layer_path(self.root, "quarantine", self.silver_table)

    @property
    def rescued_path(self) -> str:
        return layer_path(self.root, "rescued", self.bronze_table)

    @property
    def publications_path(self) -> str:
        return layer_path(self.root, "control", "publications")

    def staging_path(self, table: str) -> str:
        """A new folder for intermediate files of one run."""
        return layer_path(self.root, "staging", table) + uuid.uuid4().hex

    def gold_path(self, output: str) -> str:
        return layer_path(self.root, "gold", self.gold_table) + output

    @property
    def audit_path(self) -> str:
        return layer_path(self.root, "audit", "runs")

    @property
    def checks_path(self) -> str:
        return layer_path(self.root, "audit", "checks")

    @property
    def rules_path(self) -> str:
        return layer_path(self.root, "audit", "rules")

    @property
    def checkpoint_path(self) -> str:
        return layer_path(self.root, "checkpoints", self.bronze_table)
