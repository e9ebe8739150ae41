from __future__ import annotations

import zlib
from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession

from trilode.scratch import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL where SQL can express it."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def workspace(spark: SparkSession, sf_dir: str, query: str) -> str:
    """A shared folder of this query over these tables; a second run overwrites the first."""
    whole = zlib.crc32(sf_dir.rstrip("/").encode())
    return f"{shared_folder(spark)}/{query}/{PurePosixPath(sf_dir).name}-{whole:08x}"
