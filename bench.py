"""Times every registered query and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_REPEAT`` the timed runs per
query (the median counts) and ``BENCH_ONLY`` a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trilode.checks import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))
ONLY = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("trilode-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    """Compute every row and column without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def timed(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    drain(QUERIES[name](spark, SF_DIR))
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    names = ONLY or list(QUERIES)
    for name in names:
        timed(spark, name)
    seconds = {
        name: round(statistics.median(timed(spark, name) for _ in range(REPEAT)), 4)
        for name in names
    }
    report = {
        "metric": "sum of median seconds over all registered queries",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
