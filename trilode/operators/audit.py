"""Run history: one row per executed layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.sources.samples import one_row

AUDIT_SCHEMA = (
    "run_id string, layer string, success boolean, seconds double, input_rows bigint, "
    "output_rows bigint, output_path string, error string, started_at timestamp"
)


def audit_row(spark: SparkSession, values: Sequence) -> DataFrame:
    return one_row(spark, values, AUDIT_SCHEMA)


def audit_summary(runs: DataFrame) -> DataFrame:
    """Totals over the whole history; rate and average are NULL when there were no runs."""
    total = F.count(F.lit(1))
    good = F.count_if("success")
    return runs.agg(
        total.alias("total"),
        good.alias("successful"),
        (total - good).alias("failed"),
        F.try_divide(good * F.lit(100.0), total).alias("success_rate"),
        F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("total_seconds"),
        F.try_divide(F.sum("seconds"), total).alias("avg_seconds"),
    )


def recent_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """The last ``n`` layer runs, newest first."""
    return runs.orderBy(F.desc("started_at"), F.desc("run_id"), F.desc("layer")).limit(n)
