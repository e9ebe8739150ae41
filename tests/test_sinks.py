from dataclasses import replace
from pathlib import Path

import pytest
from helpers import plan, rows, unordered
from pyspark.sql import functions as F

from trilode.sinks import prepare, save_mode, warehouse_options, write_table, written_rows
from trilode.spec import SinkSpec


@pytest.fixture
def days(spark):
    return spark.range(90).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("date"),
        (F.col("id") % 10).alias("product_id"),
        F.col("id").cast("double").alias("revenue"),
    )


def test_dispositions():
    assert save_mode("WRITE_TRUNCATE") == "overwrite"
    assert save_mode("write_append") == "append"
    assert save_mode("WRITE_EMPTY") == "errorifexists"
    assert save_mode("Append") == "append"
    with pytest.raises(ValueError):
        save_mode("WRITE_SOMEHOW")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_formats_round_trip(spark, root, days, fmt):
    write_table(days, SinkSpec(f"{root}/t", format=fmt))
    back = spark.read.schema(days.schema).format(fmt).load(f"{root}/t")
    assert unordered(back) == unordered(days)


def test_append_overwrite_and_empty(spark, root, days):
    sink = SinkSpec(f"{root}/t")
    assert written_rows(days, sink) == 90
    assert written_rows(days, SinkSpec(f"{root}/t", mode="append")) == 90
    assert spark.read.parquet(f"{root}/t").count() == 180
    assert written_rows(days.limit(0), sink) == 0
    assert spark.read.parquet(f"{root}/t").dtypes == days.dtypes
    with pytest.raises(Exception, match="already exists"):
        write_table(days, SinkSpec(f"{root}/t", mode="WRITE_EMPTY"))


def test_rows_are_counted_after_the_last_shuffle(days, root):
    deduped = days.dropDuplicates(["product_id"]).orderBy("product_id")
    assert written_rows(deduped, SinkSpec(f"{root}/a")) == 10
    assert written_rows(days, SinkSpec(f"{root}/b", partition_by=["date"])) == 90
    assert written_rows(days, SinkSpec(f"{root}/c", cluster_by=["product_id"])) == 90


def test_partitioned_output_prunes(spark, root, days):
    write_table(days, SinkSpec(f"{root}/t", partition_by=["date"]))
    assert sorted(p.name for p in Path(root, "t").glob("date=*")) == [
        "date=2024-01-01", "date=2024-01-02", "date=2024-01-03"]
    back = spark.read.parquet(f"{root}/t").select(*days.columns)
    assert unordered(back) == unordered(days)
    text = plan(back.filter("date = DATE'2024-01-02'"))
    assert "PartitionFilters: [isnotnull(date" in text


def test_overwrite_replaces_all_partitions_in_any_session(spark, root, days):
    sink = SinkSpec(f"{root}/t", partition_by=["date"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(days, sink)
        write_table(days.filter("date = DATE'2024-01-01'"), sink)
        assert spark.read.parquet(f"{root}/t").count() == 30
        dynamic = replace(sink, options={"partitionOverwriteMode": "dynamic"})
        write_table(days.filter("date = DATE'2024-01-02'"), dynamic)
        assert spark.read.parquet(f"{root}/t").count() == 60
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_partition_layout_can_split_a_hot_value(spark, days):
    by_date = SinkSpec("p", partition_by=["date"])
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(prepare(days, by_date), "simple")
    assert prepare(days, replace(by_date, rebalance=False)) is days
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert prepare(days, by_date) is days
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_hot_partition_value_becomes_several_files(spark, root):
    hot = spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(7).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        assert written_rows(hot, SinkSpec(f"{root}/t", partition_by=["k"])) == 120_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in Path(root, "t").glob("k=*")}
    # values that hash next to the hot one are split along with it, the others stay whole
    assert files["k=7"] > 2 and sorted(files.values())[len(files) // 2] == 1
    assert spark.read.parquet(f"{root}/t").count() == 120_000


def test_clustered_output_spreads_a_hot_key(spark, root):
    hot = spark.range(60_000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    sink = SinkSpec(f"{root}/t", cluster_by=["k", "v"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        by_k = prepare(hot, replace(sink, cluster_by=["k"]))
        sizes = [r[1] for r in rows(by_k.groupBy(F.spark_partition_id()).count())]
        assert len(sizes) == 8 and max(sizes) < 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    write_table(hot.orderBy(F.rand(1)), sink)
    for file in Path(root, "t").glob("*.parquet"):
        values = [r.v for r in spark.read.parquet(str(file)).collect()]
        assert values == sorted(values)
    assert spark.read.parquet(f"{root}/t").count() == 60_000


def test_catalog_table(spark, root, days):
    spark.sql("DROP TABLE IF EXISTS sink_days")
    write_table(days, SinkSpec(f"{root}/t", table="sink_days", mode="WRITE_TRUNCATE"))
    write_table(days, SinkSpec(f"{root}/t", table="sink_days", mode="WRITE_APPEND"))
    assert spark.table("sink_days").count() == 180
    spark.sql("DROP TABLE sink_days")


def test_warehouse_options():
    sink = SinkSpec(table="p.d.t", format="bigquery", mode="WRITE_TRUNCATE", partition_by=["date"],
                    cluster_by=["product_id", "region"], options={"parentProject": "p"})
    assert warehouse_options(sink) == {
        "table": "p.d.t", "writeMethod": "direct", "partitionField": "date",
        "partitionType": "DAY", "clusteredFields": "product_id,region", "parentProject": "p",
    }
    assert warehouse_options(SinkSpec(table="p.d.t")) == {"table": "p.d.t",
                                                         "writeMethod": "direct"}


class Writer:
    """Records a connector write; nothing is sent."""

    def __init__(self):
        self.asked = {}

    @property
    def write(self):
        return self

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def mode(self, mode):
        self.asked["mode"] = mode
        return self

    def save(self):
        self.asked["saved"] = True


def test_connector_writes():
    frame = Writer()
    write_table(frame, SinkSpec(table="p.d.t", format="bigquery", mode="WRITE_TRUNCATE"))
    assert frame.asked == {"format": "bigquery", "table": "p.d.t", "writeMethod": "direct",
                           "mode": "overwrite", "saved": True}
    frame = Writer()
    write_table(frame, SinkSpec(table="t", format="jdbc", mode="append", options={"url": "u"}))
    assert frame.asked == {"format": "jdbc", "dbtable": "t", "url": "u", "mode": "append",
                           "saved": True}


def test_a_sink_needs_a_target(days):
    with pytest.raises(ValueError):
        write_table(days, SinkSpec())
