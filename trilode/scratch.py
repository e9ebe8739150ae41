"""Shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="trilode-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, one subfolder per application.

    Where the setting is missing, a temporary folder serves a local master only: executors on
    other machines could not see it.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
        base = _local_folder()
    return f"{base.rstrip('/')}/trilode/{spark.conf.get('spark.app.id')}"
