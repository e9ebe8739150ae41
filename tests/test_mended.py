"""Inputs on which rows were once lost or answers wrong."""

import pytest
from helpers import unordered
from pyspark.sql import functions as F

from trilode import flow_from_config
from trilode.operators import dedup, fill_nulls, fused_groups, group_table, metric_table, row_accounting
from trilode.operators.aggregate import rows_of
from trilode.plans import run
from trilode.sinks import write_table
from trilode.spec import (
    AggSpec,
    CatalogSource,
    CleaningSpec,
    EventSource,
    FileSource,
    FlowSpec,
    GroupSpec,
    IncrementSpec,
    MetricSpec,
    SinkSpec,
)


def flow(root, name, source):
    return FlowSpec("d", root, f"{name}_raw", f"{name}_clean", f"{name}_gold", source)


def test_feeds_under_one_root_have_marks_of_their_own(spark, root):
    for name, top in (("old", 900), ("young", 5)):
        spark.range(top - 2, top).selectExpr("id AS k").createOrReplaceTempView(f"feed_{name}")
        source = CatalogSource(f"SELECT * FROM feed_{name}", increment=IncrementSpec("k"))
        for rows in (2, 0):
            assert run(spark, flow(root, name, source), ["bronze"])["bronze"].output_rows == rows


def test_kinds_of_bronze_do_not_mix(spark, root):
    spark.range(3).write.json(f"{root}/in")
    stream = flow(root, "x", EventSource(f"{root}/in", "json", schema="id bigint"))
    others = [EventSource(f"{root}/in", "json", streaming=False), FileSource(f"{root}/in", "json"),
              CatalogSource("SELECT 1 AS k", increment=IncrementSpec("k"))]
    assert run(spark, stream, ["bronze"])["bronze"].output_rows == 3
    for source in others:
        result = run(spark, flow(root, "x", source), ["bronze"])["bronze"]
        assert not result.success and "stream" in result.error
    spark.range(3, 5).write.mode("append").json(f"{root}/in")
    result = run(spark, stream, ["bronze", "silver"])
    assert result["bronze"].output_rows == 2 and result["silver"].output_rows == 5
    assert spark.read.parquet(stream.bronze_path).count() == 5  # any reader sees all of it
    batch = flow(root, "y", others[0])
    for _ in range(2):
        assert run(spark, batch, ["bronze"])["bronze"].success
    late = flow(root, "y", EventSource(f"{root}/in", "json", schema="id bigint"))
    assert not run(spark, late, ["bronze"])["bronze"].success


def test_hours_without_a_zone_stay_apart(spark):
    df = spark.sql("""SELECT CAST(t AS TIMESTAMP_NTZ) AS t FROM VALUES
        ('2024-03-10 02:30:00'), ('2024-03-10 03:30:00'), (NULL) AS v(t)""")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        table = group_table(df, GroupSpec("g", [AggSpec("*", "count", "n")], date_column="t", grain="hour"))
        assert table.dtypes[0] == ("hour", "timestamp_ntz")
        assert sorted(r.hour.hour for r in table.collect() if r.hour) == [2, 3]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_collated_keys(spark):
    df = spark.sql("SELECT k COLLATE UTF8_LCASE AS k, n FROM VALUES ('a', 1), ('A', 1), ('b', 1) AS v(k, n)")
    assert dedup(df, ["k"]).count() == 2 and dedup(df, ["k", "n"]).count() == 2
    assert dedup(df, ["k"], ["n"]).count() == 2
    assert row_accounting(df, CleaningSpec(dedup_keys=["k"])).first().silver == 2


def test_nan_is_filled(spark):
    df = spark.sql("SELECT * FROM VALUES (CAST('NaN' AS DOUBLE)), (NULL), (1.5D) AS v(x)")
    assert unordered(fill_nulls(df, {"x": "0"})) == [(0.0,), (0.0,), (1.5,)]


def test_alike_measures_and_spellings(spark):
    df = spark.sql("SELECT * FROM VALUES (1, true, NULL), (1, true, 'x'), (2, false, 'x') AS v(Region, flag, if_flag)")
    groups = [
        GroupSpec("a", [AggSpec("if_flag", "count", "n"), AggSpec("flag", "count_if", "m")], ["region"]),
        GroupSpec("b", [AggSpec("FLAG", "count_if", "m")], ["REGION", "flag"]),
    ]
    fused = fused_groups(df, groups)
    for group in groups:
        assert unordered(rows_of(fused, groups, group)) == unordered(group_table(df, group))


def test_metrics_do_not_gather_the_table(spark):
    with pytest.raises(ValueError, match="collect_list"):
        metric_table(spark.range(3), MetricSpec("x", "size(collect_list(id))", "x"))
    assert metric_table(spark.range(3), MetricSpec("x", "max(id)", "x")).first().x == 2


def test_clustered_output_with_a_map(spark, root):
    df = spark.range(20).select("id", F.create_map(F.lit("k"), "id").alias("m"))
    write_table(df, SinkSpec(f"{root}/t", cluster_by=["id"]))
    assert spark.read.parquet(f"{root}/t").count() == 20


def test_fused_staging_has_few_files_and_goes_away(spark, root):
    import os

    spark.range(1000).selectExpr("id % 7 AS a", "id % 5 AS b", "id AS v").write.parquet(f"{root}/in")
    outputs = [GroupSpec(k, [AggSpec("v", "sum", "s")], [k]) for k in ("a", "b")]
    one = FlowSpec("d", root, "r", "c", "g", FileSource(f"{root}/in", "parquet"), outputs=outputs)
    assert all(r.success for r in run(spark, one).values())
    assert os.listdir(f"{root}/staging/g") == []
    assert spark.read.parquet(one.gold_path("a")).count() == 7


def test_config_lays_out_parquet_gold(spark, root):
    spark.range(100).selectExpr(
        "CAST(DATE'2024-01-01' + CAST(id % 5 AS INT) AS STRING) AS day", "id % 3 AS branch", "id AS fee",
    ).write.option("header", True).csv(f"{root}/in")
    config = {
        "business_domain": "Loans", "bronze_table_name": "b", "silver_table_name": "s",
        "gold_table_name": "g", "source": {"path": f"{root}/in", "options": {"header": "true"}},
        "schema_info": "day: date\nbranch: integer\nfee: double",
        "cleaning_rules": {
            "validation_rules": [{"column": "fee", "rule": "col('fee') >= 10"}],
            "deduplication_columns": ["day", "branch", "fee"]},
        "aggregations": {"daily": {
            "type": "group_by", "date_column": "day", "sort": ["date"],
            "aggregations": [{"column": "fee", "function": "sum", "alias": "fees"}]},
            "total": {"type": "agg", "expression": "sum('fee')", "alias": "total"}},
        "gcp": {"warehouse": {"partitioning": {"enabled": True, "field": "date"}, "clustering": ["fees"]}},
    }
    one = flow_from_config(config, root=root)
    assert all(r.success for r in run(spark, one).values())
    gold = spark.read.parquet(one.gold_path("daily"))
    assert gold.count() == 5 and set(gold.columns) == {"fees", "date"}
    assert any("date=2024-01-03" in f for f in gold.inputFiles())
    assert spark.read.parquet(one.gold_path("total")).first().total == sum(range(10, 100))
