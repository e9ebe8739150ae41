"""Small append-only tables: audit rows, checks, marks. Every append leaves a small file."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trilode.sinks.write import remove

MOST_FILES = 64
SMALL_BYTES = 8 * 1024 * 1024


def small_files(spark: SparkSession, path: str, below: int = SMALL_BYTES) -> list[str]:
    """Names of data files with fewer bytes than ``below``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [
        (status.getPath().getName(), status.getLen()) for status in store.listStatus(folder)
        if status.isFile()
    ]
    return [name for name, size in found if size < below and name[0] not in "._"]


def compact_log(
    spark: SparkSession, path: str, schema: StructType, most: int = MOST_FILES
) -> int:
    """Put the small files of a log together once there are more than ``most``; returns how many.

    The new file is in place before the old ones go, so no moment and no failure loses a row. A
    compaction that dies in between, or two at a time, leave rows twice: rows of a log are told apart
    by their run or load, so :func:`read_log` and the next compaction drop the copies. Rows appended
    meanwhile stay where they are. A reader that has listed an old file and finds it gone must read
    again.
    """
    names = small_files(spark, path)
    if len(names) <= most:
        return 0
    base = path.rstrip("/")
    staging = f"{base}.compact-{uuid.uuid4().hex}"
    # a file that another compaction has removed meanwhile is in that one's file
    old = spark.read.option("ignoreMissingFiles", "true").schema(schema).parquet(path).where(
        F.col("_metadata.file_name").isin(names))
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        old.distinct().coalesce(1).write.parquet(staging)
        for name in small_files(spark, staging, 1 << 62):
            if not store.rename(hadoop.Path(f"{staging}/{name}"), hadoop.Path(f"{base}/{name}")):
                raise OSError(f"{name} could not be moved to {base}")
    finally:
        remove(spark, staging)
    for name in names:
        store.delete(hadoop.Path(f"{base}/{name}"), False)
    return len(names)


def append_log(df: DataFrame, path: str, most: int = MOST_FILES) -> None:
    df.write.mode("append").parquet(path)
    compact_log(df.sparkSession, path, df.schema, most)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).distinct()
