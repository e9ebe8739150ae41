"""One write for rows that go to two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trilode.sinks.write import entries, remove, swap_all, write_table
from trilode.sources.files import ensure_table
from trilode.spec import SinkSpec

OUTCOME = "outcome"


def split_rows(
    df: DataFrame, good: Column, place: str, other_place: str, staging: str, empty: bool = True
) -> tuple[int, int]:
    """Rows for which ``good`` holds to ``place``, all others to ``other_place``; both counts.

    ``df`` is computed once. Both parts are written to ``staging`` and then put in place together, so
    a run that fails leaves the tables of the last one. Without ``empty`` a part without rows is not
    put in place at all.
    """
    spark = df.sparkSession
    is_good = F.coalesce(good, F.lit(False))
    rows = Observation()
    counted = df.observe(rows, F.count_if(is_good).alias("good"), F.count(F.lit(1)).alias("rows"))
    outcome = F.when(is_good, "good").otherwise("other")
    try:
        write_table(
            counted.withColumn(OUTCOME, outcome),
            SinkSpec(path=staging, partition_by=(OUTCOME,), rebalance=False,
                     options={"compression": "snappy"}))
        parts = [(f"{staging}/{OUTCOME}=good", place), (f"{staging}/{OUTCOME}=other", other_place)]
        if empty:
            for part, _ in parts:
                ensure_table(spark, part, df.schema)  # where no row had this outcome
        made = entries(spark, staging)
        swap_all(spark, [(part, goal) for part, goal in parts if part.rpartition("/")[2] in made])
    finally:
        remove(spark, staging)
    found = rows.get
    return found["good"], found["rows"] - found["good"]
