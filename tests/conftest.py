from __future__ import annotations

import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    with tempfile.TemporaryDirectory(prefix="trilode-test-") as folder:
        session = (
            SparkSession.builder.master("local[8]")
            .appName("trilode-tests")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.checkpoint.dir", f"{folder}/shared")
            .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
            .getOrCreate()
        )
        session.sparkContext.setLogLevel("ERROR")
        yield session
        session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)
