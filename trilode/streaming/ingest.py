"""Continuous ingest of arriving files. The checkpoint remembers which files went in."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from trilode.sinks.split import split_rows
from trilode.sinks.write import entries, move_files, remove, written_rows
from trilode.sources.files import RESCUED, configure, ensure_table
from trilode.sources.lineage import SOURCE_FILE, with_lineage
from trilode.sources.queries import NO_VALUE
from trilode.sources.samples import one_row
from trilode.spec import EventSource, SinkSpec

EPOCH = "epoch"
BATCH_ID = "batch_id"


def landing_stream(spark: SparkSession, source: EventSource) -> DataFrame:
    """The landing directory as a stream, stamped with lineage.

    With ``archive_dir``, which must lie outside the landing path, every row names its file.
    """
    reader = configure(spark.readStream, source)
    if source.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", source.max_files_per_trigger)
    tracked = replace(source, track_file=source.track_file or bool(source.archive_dir))
    return with_lineage(reader.load(source.path), tracked)


# ---------------------------------------------------------------- identity of a checkpoint


def _folder(path: str, *names: str) -> str:
    return "/".join([path.rstrip("/"), *names])


def checkpoint_epoch(spark: SparkSession, checkpoint: str) -> str:
    """A random id kept in the checkpoint folder, so that it is lost with the checkpoint."""
    path = _folder(checkpoint, "trilode_epoch")
    found = None
    if entries(spark, path):
        found = spark.read.schema("epoch string").parquet(path).first()
    if found is None:
        row = one_row(spark, (uuid.uuid4().hex,), "epoch string")
        row.write.mode("overwrite").parquet(path)
        found = spark.read.schema("epoch string").parquet(path).first()
    return found.epoch


def stored_epochs(spark: SparkSession, out: str) -> set[str]:
    """Epochs of which Bronze holds batches; None in the set is a table from before epochs."""
    heads = [name.partition("=") for name in entries(spark, out)]
    return {value for name, _, value in heads if name == EPOCH} | {
        "" for name, _, _ in heads if name == BATCH_ID}


def _accepted_epoch(spark: SparkSession, source: EventSource, out: str, checkpoint: str) -> str:
    epoch = checkpoint_epoch(spark, checkpoint)
    known = stored_epochs(spark, out)
    held = [n for n in entries(spark, _folder(out, f"{EPOCH}={epoch}")) if NO_VALUE not in n]
    if held and "offsets" not in entries(spark, checkpoint):
        raise ValueError(f"the checkpoint at {checkpoint} has lost its offsets, Bronze holds its batches;"
                         " remove the whole checkpoint folder to start another")
    if known - {epoch} and source.after_reset == "refuse":
        raise ValueError(
            f"Bronze at {out} holds batches of another checkpoint than {checkpoint}; files still in "
            "the landing may be among them. Restore the checkpoint, or set after_reset to 'add' or "
            "'new_files'")
    return epoch


# ---------------------------------------------------------------- archive


def _move_committed(spark: SparkSession, source: EventSource, checkpoint: str) -> None:
    """Move the files of committed batches out of the landing.

    A batch leaves a list of its files before it is committed; the list goes when they are moved, so
    a run that died in between is made good by the next one. The driver sees the names of one
    batch's files at a time.
    """
    if not source.archive_dir:
        return
    committed = set(entries(spark, _folder(checkpoint, "commits")))
    lists = _folder(checkpoint, "trilode_files")
    for batch in sorted(set(entries(spark, lists)) & committed, key=int):
        one = _folder(lists, batch)
        names = spark.read.schema(f"{SOURCE_FILE} string").parquet(one).collect()
        move_files(spark, [r[0] for r in names], source.path, source.archive_dir, f"batch-{batch}")
        remove(spark, one)


# ---------------------------------------------------------------- ingest


def _batch_folder(out: str, epoch: str, batch_id: int) -> str:
    return _folder(out, f"{EPOCH}={epoch}", f"{BATCH_ID}={batch_id}")


def ingest_stream(
    spark: SparkSession,
    source: EventSource,
    out: str,
    checkpoint: str,
    every: str | None = None,
    written: Callable[[int], None] = lambda rows: None,
    rescued: str | None = None,
) -> StreamingQuery:
    """Add arriving files to the Parquet table at ``out``, a partition per checkpoint and batch.

    A batch that runs again after a failure overwrites its own partition, so every file counts once;
    the table is plain Parquet that any reader sees whole. A new checkpoint counts its batches from 0
    again, in a partition of its own; without leave (``after_reset``) it is refused where Bronze
    holds batches of another one. Without ``every`` the query takes what has arrived and ends; with
    an interval it keeps going. ``written`` hears the rows of each batch. A source with ``rescue``
    puts lines that do not fit under ``rescued``, by checkpoint and batch as well.
    """
    if source.rescue and not rescued:
        raise ValueError("a source with rescue needs a place for lines that do not fit")
    epoch = _accepted_epoch(spark, source, out, checkpoint)
    others = stored_epochs(spark, out) - {epoch}
    sink = SinkSpec(
        path=out,
        options={"compression": "snappy", "partitionOverwriteMode": "dynamic"},
        partition_by=(EPOCH, BATCH_ID),
        rebalance=False,  # a batch has one partition value
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        _move_committed(spark, source, checkpoint)
        if others and source.after_reset == "new_files":
            held = spark.read.schema(f"{SOURCE_FILE} string, {EPOCH} string").parquet(out).where(
                F.col(EPOCH) != epoch).select(SOURCE_FILE).distinct()
            batch = batch.join(held, SOURCE_FILE, "left_anti").select(*batch.columns)
        folders = [_batch_folder(out, epoch, batch_id)]
        if source.rescue:
            folders.append(_batch_folder(rescued, epoch, batch_id))
            fit, _ = split_rows(batch, F.col(RESCUED).isNull(), *folders,
                                _folder(checkpoint, "trilode_staging"), empty=False)
            written(fit)
        else:
            written(written_rows(batch.withColumns(
                {EPOCH: F.lit(epoch), BATCH_ID: F.lit(batch_id).cast("long")}), sink))
        if source.archive_dir:
            folders = [folder for folder in folders if entries(spark, folder)]
            if folders:
                spark.read.schema(f"{SOURCE_FILE} string").parquet(*folders).distinct().write.mode(
                    "overwrite").parquet(_folder(checkpoint, "trilode_files", str(batch_id)))

    writer = (
        landing_stream(spark, source)
        .writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def load_arrivals(
    spark: SparkSession, source: EventSource, out: str, checkpoint: str,
    written: Callable[[int], None] = lambda rows: None,
    rescued: str | None = None,
) -> int:
    """Ingest what has arrived since the last call; returns the rows added to ``out``.

    The rows are those of the new batches; what is already in Bronze is not looked at. With
    ``archive_dir`` the files of all committed batches have left the landing afterwards; a file
    without a row stays.
    """
    counts: list[int] = []
    epoch = _accepted_epoch(spark, source, out, checkpoint)
    for table in [out, rescued] if source.rescue else [out]:
        ensure_table(spark, _folder(table, f"{EPOCH}={epoch}", f"{BATCH_ID}={NO_VALUE}"),
                     landing_stream(spark, source).schema)

    def count(rows: int) -> None:
        counts.append(rows)
        written(rows)

    ingest_stream(
        spark, source, out, checkpoint, written=count, rescued=rescued).awaitTermination()
    _move_committed(spark, source, checkpoint)
    return sum(counts)


def read_arrivals(
    spark: SparkSession, source: EventSource, out: str, parts: bool = False
) -> DataFrame:
    """What has been ingested; a schema of its own, as there may be no file yet to take it from.

    With ``parts`` every row says which checkpoint and batch brought it.
    """
    added = [T.StructField(EPOCH, T.StringType()), T.StructField(BATCH_ID, T.LongType())]
    schema = T.StructType([*landing_stream(spark, source).schema, *added])
    rows = spark.read.schema(schema).parquet(out)
    rows = rows.drop(RESCUED) if source.rescue else rows
    return rows if parts else rows.drop(EPOCH, BATCH_ID)
