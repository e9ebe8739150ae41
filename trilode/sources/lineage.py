"""Bronze stamps: when a row came in and from where."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilode.spec import CatalogSource, Source

INGESTED_AT = "ingestion_timestamp"
SOURCE_FILE = "source_file"
SOURCE_QUERY = "source_query"


def with_lineage(df: DataFrame, source: Source) -> DataFrame:
    """Apply directly on the scan: the file name is a hidden column of the scan itself."""
    if isinstance(source, CatalogSource):
        origin = {SOURCE_QUERY: F.lit(source.query)}
    elif source.track_file or source.rescue:  # lines that do not fit are counted by file
        origin = {SOURCE_FILE: F.col("_metadata.file_path")}
    else:
        origin = {SOURCE_FILE: F.lit(source.path)}
    return df.withColumns({INGESTED_AT: F.current_timestamp(), **origin})


def lineage_column(source: Source) -> str:
    return SOURCE_QUERY if isinstance(source, CatalogSource) else SOURCE_FILE
