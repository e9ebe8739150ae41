"""What several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.scratch import shared_folder

# White space of the word rule used throughout: a word is ``[^\x20\x09-\x0D]+``.
SPACE = "[\\x20\\x09-\\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors share."""
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the work is done once, and a lost
    executor costs a re-read and not the lineage before it."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def words(text: Column | str) -> Column:
    """Words of a text as an array, empty for a null or blank text."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def lower_ascii(text: Column | str) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(column: str, n: int) -> Column:
    """``crc32(id as text) mod n``; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % n


def slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small pieces, so that a task holds few texts as Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem
