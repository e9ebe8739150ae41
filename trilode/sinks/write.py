"""One writer for files, catalog tables, JDBC tables and warehouse connectors."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from trilode.spec import SinkSpec

FILE_FORMATS = ("parquet", "csv", "json", "orc")

# Warehouse write dispositions and their Spark save modes.
DISPOSITIONS = {
    "WRITE_TRUNCATE": "overwrite",
    "WRITE_APPEND": "append",
    "WRITE_EMPTY": "errorifexists",
}
SAVE_MODES = ("append", "overwrite", "ignore", "error", "errorifexists")


_UNHASHABLE = re.compile(r"\b(map<|variant\b)")


def save_mode(disposition: str) -> str:
    mode = DISPOSITIONS.get(disposition.upper(), disposition.lower())
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown write disposition {disposition!r}")
    return mode


def prepare(df: DataFrame, sink: SinkSpec) -> DataFrame:
    """Lay rows out for the sink.

    Partitioned output is rebalanced on the partition columns: one file set per partition value,
    while adaptive execution splits a value that holds far more rows than the rest. Without
    adaptive execution a hot value would be one task, so rows are then written where they are.
    Clustered output is range-partitioned; a hash of the row without its maps breaks ties, so a hot cluster
    key also spreads over several tasks.
    """
    if sink.cluster_by:
        keys = [*sink.partition_by, *sink.cluster_by]
        hashable = [f.name for f in df.schema if not _UNHASHABLE.search(f.dataType.simpleString())]
        tie = [F.xxhash64(*hashable)] if hashable else []
        return df.repartitionByRange(*keys, *tie).sortWithinPartitions(*keys)
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    if sink.partition_by and sink.rebalance and adaptive:
        return df.hint("rebalance", *sink.partition_by)
    return df


def warehouse_options(sink: SinkSpec) -> dict[str, str]:
    """Connector options of a direct warehouse write."""
    options = {"table": sink.table, "writeMethod": "direct"}
    if sink.partition_by:
        options["partitionField"] = sink.partition_by[0]
        options["partitionType"] = sink.partition_type
    if sink.cluster_by:
        options["clusteredFields"] = ",".join(sink.cluster_by)
    return {**options, **sink.options}


def write_table(df: DataFrame, sink: SinkSpec, rows: Observation | None = None) -> None:
    """Files when the sink has a path, a catalog table when it has a name and a file format,
    otherwise the named connector (``jdbc``, ``bigquery``, ...).

    ``rows`` observes the count after the last shuffle, in the stage whose task results are each
    counted once, so tasks that run again do not inflate it.
    """
    mode = save_mode(sink.mode)
    files = sink.format in FILE_FORMATS
    if files and not (sink.path or sink.table):
        raise ValueError("a sink needs a path or a table name")
    if files:
        df = prepare(df, sink)
    if rows is not None:
        df = df.observe(rows, F.count(F.lit(1)).alias("rows"))
    if sink.format == "jdbc":
        df.write.format("jdbc").options(dbtable=sink.table, **sink.options).mode(mode).save()
        return
    if not files:
        df.write.format(sink.format).options(**warehouse_options(sink)).mode(mode).save()
        return
    writer = df.write.format(sink.format).mode(mode)
    if sink.partition_by:
        # overwriting means the whole table, whatever the session says, unless the sink differs
        writer = writer.partitionBy(*sink.partition_by).option("partitionOverwriteMode", "static")
    writer = writer.options(**sink.options)
    if not sink.table:
        writer.save(sink.path)
    elif sink.path:
        writer.option("path", sink.path).saveAsTable(sink.table)
    else:
        writer.saveAsTable(sink.table)


def written_rows(df: DataFrame, sink: SinkSpec) -> int:
    """Write, and return the number of rows written without reading anything again."""
    rows = Observation()
    write_table(df, sink, rows)
    return rows.get["rows"]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate results in whatever store it lies; none is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names at the top of a folder, without Spark's own marker files; none if it is missing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return []
    names = [status.getPath().getName() for status in store.listStatus(folder)]
    return [n for n in names if n != "_SUCCESS" and not n.startswith(".")]


def swap_all(spark: SparkSession, moves: Sequence[tuple[str, str]]) -> None:
    """Put each folder ``new`` of ``(new, place)`` in the place of the table at ``place``.

    Old tables are moved aside first and removed last, so none is ever half overwritten; a failure
    puts all of them back.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    done: list[tuple] = []  # moves to undo, in order

    def move(store, source, goal) -> None:
        if not store.rename(source, goal):
            raise OSError(f"{source} could not be moved to {goal}")
        done.append((store, goal, source))

    asides = []
    try:
        for new, place in moves:
            source, goal = hadoop.Path(new.rstrip("/")), hadoop.Path(place.rstrip("/"))
            store = goal.getFileSystem(conf)
            store.mkdirs(goal.getParent())
            if not store.exists(source):
                raise OSError(f"there is nothing at {new}")
            if store.exists(goal):
                aside = hadoop.Path(f"{place.rstrip('/')}.old-{uuid.uuid4().hex}")
                move(store, goal, aside)
                asides.append((store, aside))
            move(store, source, goal)
    except Exception:
        for store, source, goal in reversed(done):
            store.rename(source, goal)
        raise
    for store, aside in asides:
        store.delete(aside, True)


def swap_in(spark: SparkSession, new: str, place: str) -> None:
    swap_all(spark, [(new, place)])


def replaced_rows(df: DataFrame, sink: SinkSpec, staging: str) -> int:
    """Like :func:`written_rows` for overwritten files, but written to ``staging`` and then put in
    place: a write that fails leaves the old table."""
    spark = df.sparkSession
    try:
        rows = written_rows(df, replace(sink, path=staging))
        swap_in(spark, staging, sink.path)
    finally:
        remove(spark, staging)
    return rows


def move_files(
    spark: SparkSession, files: Sequence[str], root: str, target: str, label: str
) -> None:
    """Move files from under ``root`` to the same place under ``target``.

    ``files`` are URIs as Spark names them. A file that is gone has been moved before; where the
    place is taken, ``label`` is put behind the name.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    base = hadoop.Path(root)
    store = base.getFileSystem(conf)
    prefix = store.makeQualified(base).toUri().getPath().rstrip("/") + "/"
    for name in files:
        path = hadoop.Path(spark._jvm.java.net.URI(name))
        if not store.exists(path):
            continue
        whole = path.toUri().getPath()
        inner = whole.removeprefix(prefix) if whole.startswith(prefix) else path.getName()
        goal = hadoop.Path(f"{target.rstrip('/')}/{inner}")
        if store.exists(goal):
            goal = hadoop.Path(f"{target.rstrip('/')}/{inner}.{label}")
        store.mkdirs(goal.getParent())
        if not store.rename(path, goal):
            raise OSError(f"{name} could not be moved to {goal}")
