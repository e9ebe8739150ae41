"""CSV, JSON and Parquet scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trilode.spec import FileSource


RESCUED = "rescued_text"


def configure(reader, source: FileSource):
    """The reader options shared by the batch and the streaming form of a scan.

    A declared schema is checked against CSV header lines, since CSV columns go by position.
    """
    reader = reader.format(source.format)
    if source.schema:
        schema = f"{source.schema}, {RESCUED} string" if source.rescue else source.schema
        reader = reader.schema(schema).option("enforceSchema", "false")
    if source.rescue:
        reader = reader.option("columnNameOfCorruptRecord", RESCUED)
    if source.suffix:
        reader = reader.option("pathGlobFilter", f"*{source.suffix}")
    return reader.options(**source.options)


def read_files(spark: SparkSession, source: FileSource) -> DataFrame:
    return configure(spark.read, source).load(source.path)


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: str | StructType) -> None:
    """Make an empty Parquet table at ``path`` unless something is there already."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    nothing = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    nothing.write.mode("ignore").parquet(path)


def rescued_report(rescued: DataFrame) -> DataFrame:
    """Lines that did not fit, by file."""
    return rescued.groupBy("source_file").agg(F.count(F.lit(1)).alias("rescued"))
