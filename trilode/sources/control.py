"""High-water marks: an append-only control table, one row per committed load.

Every load leaves one small file, and many small files are put together.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilode.sinks.log import append_log
from trilode.sources.files import ensure_table
from trilode.sources.samples import one_row

CONTROL_SCHEMA = (
    "source string, column_name string, last_value string, updated_at timestamp, "
    "load_number bigint, rows bigint, late_ties bigint, late_unmarked bigint"
)


class Mark(NamedTuple):
    """The newest mark of a source, the number of committed loads, and the load that reached it."""

    value: str | None
    loads: int
    reached: int


def mark_text(column: Column, dtype: T.DataType) -> Column:
    """A text form that casts back to the same value, whatever the reading session's time zone."""
    if isinstance(dtype, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSSXXX")
    return column.cast("string")


def newest_mark(spark: SparkSession, control_path: str, source: str, column: str) -> Mark:
    ensure_table(spark, control_path, CONTROL_SCHEMA)
    number = F.coalesce("load_number", F.lit(0))
    loads = (
        spark.read.schema(CONTROL_SCHEMA)
        .parquet(control_path)
        .filter((F.col("source") == source) & (F.col("column_name") == column))
        .groupBy("last_value")
        .agg(F.max(F.struct(number, "updated_at")).alias("newest"), F.min(number).alias("reached"),
             (F.max(number) + 1).alias("loads"))
    )
    # a row per distinct mark; only the newest comes to the driver
    top = loads.orderBy(F.desc("newest")).first()
    return Mark(top.last_value, top.loads, top.reached) if top else Mark(None, 0, 0)


def last_mark(spark: SparkSession, control_path: str, source: str, column: str) -> str | None:
    return newest_mark(spark, control_path, source, column).value


def write_mark(
    spark: SparkSession, control_path: str, source: str, column: str, value: str | None,
    load_number: int = 0, rows: int | None = None, late_ties: int = 0, late_unmarked: int = 0,
) -> None:
    row = (source, column, value, F.current_timestamp(), load_number, rows, late_ties, late_unmarked)
    append_log(one_row(spark, row, CONTROL_SCHEMA), control_path)
