"""Aggregates, trends and the layouts they are written in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode import functions as T
from trilode.checks.registry import check, table, workspace
from trilode.checks.silver import LINE_CLEANING, LINE_SILVER
from trilode.operators import (
    clean,
    fused_groups,
    group_table,
    metric_table,
    metrics,
    top_n,
    union_all,
)
from trilode.operators.aggregate import OUTPUT, rows_of
from trilode.plans.gold import read_outputs
from trilode.plans.run import run
from trilode.sinks import write_table
from trilode.sources import read_layer
from trilode.spec import AggSpec, FileSource, FlowSpec, GroupSpec, MetricSpec, SinkSpec


def cents(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of doubles depend on the order of adding in their last bits."""
    return df.withColumns({c: F.round(c, 2) for c in columns})


def fine(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Means: enough digits to tell rows apart, few enough to be free of the last bits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


@check(
    """SELECT ROUND(sum(l_extendedprice), 2) AS total_revenue,
              ROUND(avg(l_extendedprice), 4) AS avg_order_value FROM lineitem"""
)
def gold_metrics_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = metrics(
        table(spark, sf_dir, "lineitem"),
        [
            MetricSpec("total_revenue", "sum(l_extendedprice)", "total_revenue"),
            MetricSpec("avg_order_value", "avg(l_extendedprice)", "avg_order_value"),
        ],
    )
    return fine(cents(row, "total_revenue"), 4, "avg_order_value")


@check("SELECT ROUND(sum(o_totalprice), 2) AS total_revenue FROM orders")
def gold_metric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = MetricSpec("revenue", "sum(o_totalprice)", "total_revenue")
    return cents(metric_table(table(spark, sf_dir, "orders"), metric), "total_revenue")


REVENUE_BY_PRODUCT = GroupSpec(
    "revenue_by_product", [AggSpec("l_extendedprice", "sum", "revenue")], ["l_partkey"],
    sort=["revenue DESC"],
)


@check("SELECT l_partkey, ROUND(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1")
def gold_revenue_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(group_table(table(spark, sf_dir, "lineitem"), REVENUE_BY_PRODUCT), "revenue")


@check(
    f"""SELECT l_partkey, ROUND(sum(l_extendedprice), 2) AS revenue
        FROM ({LINE_SILVER}) silver GROUP BY 1"""
)
def gold_clean_revenue_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning and aggregation in one plan: the flagship."""
    silver = clean(table(spark, sf_dir, "lineitem"), LINE_CLEANING)
    return cents(group_table(silver, REVENUE_BY_PRODUCT), "revenue")


@check(
    """SELECT o_orderpriority, ROUND(sum(o_totalprice), 2) AS revenue
       FROM orders GROUP BY o_orderpriority"""
)
def gold_revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = GroupSpec(
        "revenue_by_region", [AggSpec("o_totalprice", "sum", "revenue")], ["o_orderpriority"],
        sort=["revenue DESC"],
    )
    return cents(group_table(table(spark, sf_dir, "orders"), group), "revenue")


DAILY = GroupSpec(
    "daily_trend", [AggSpec("o_totalprice", "sum", "daily_revenue")],
    date_column="o_orderdate", sort=["date ASC"],
)
DAILY_SQL = """SELECT CAST(o_orderdate AS DATE) AS date,
                      ROUND(sum(o_totalprice), 2) AS daily_revenue FROM orders GROUP BY 1"""


@check(DAILY_SQL)
def gold_daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cents(group_table(table(spark, sf_dir, "orders"), DAILY), "daily_revenue")


@check(
    """SELECT date_trunc('hour', ts) AS hour, ROUND(avg(value), 11) AS hourly_avg
       FROM events GROUP BY 1"""
)
def gold_hourly_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = GroupSpec(
        "hourly_avg", [AggSpec("value", "avg", "hourly_avg")],
        date_column="ts", grain="hour", sort=["hour ASC"],
    )
    return fine(group_table(table(spark, sf_dir, "events"), group), 11, "hourly_avg")


BATTERY = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"


@check(
    f"""SELECT user_id, min({BATTERY}) AS min_battery, max({BATTERY}) AS max_battery
        FROM events GROUP BY user_id"""
)
def gold_min_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = GroupSpec(
        "low_battery_devices",
        [AggSpec("battery", "min", "min_battery"), AggSpec("battery", "max", "max_battery")],
        ["user_id"], sort=["min_battery ASC"],
    )
    readings = table(spark, sf_dir, "events").withColumn("battery", F.expr(BATTERY))
    return group_table(readings, group)


@check(
    """SELECT CAST(o_orderdate AS DATE) AS date, ROUND(sum(o_totalprice), 2) AS daily_volume,
              count(o_orderkey) AS transaction_count, count(*) AS row_count
       FROM orders GROUP BY 1"""
)
def gold_daily_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = GroupSpec(
        "daily_volume",
        [AggSpec("o_totalprice", "sum", "daily_volume"),
         AggSpec("o_orderkey", "count", "transaction_count"),
         AggSpec("*", "count", "row_count")],
        date_column="o_orderdate", sort=["date ASC"],
    )
    return cents(group_table(table(spark, sf_dir, "orders"), group), "daily_volume")


@check(
    """SELECT ROUND(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2)
                AS total_revenue,
              ROUND(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 4)
                AS avg_value,
              CAST(sum(CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END) AS BIGINT)
                AS fraud_count
       FROM orders"""
)
def gold_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = T.equals("o_orderstatus", "F")
    row = metrics(
        table(spark, sf_dir, "orders"),
        [
            MetricSpec("total_revenue", T.sum_when(done, "o_totalprice"), "total_revenue"),
            MetricSpec("avg_value", T.avg_when(done, "o_totalprice"), "avg_value"),
            MetricSpec("fraud_count", T.count_when("o_orderkey % 97 = 0"), "fraud_count"),
        ],
    )
    return fine(cents(row, "total_revenue"), 4, "avg_value")


@check(
    """SELECT ROUND(CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE)
                    / NULLIF(count(*), 0), 9) AS completion_rate FROM orders"""
)
def gold_completion_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = T.ratio(T.count_when("o_orderstatus = 'F'"), F.count(F.lit(1)))
    metric = MetricSpec("completion_rate", F.round(rate, 9), "completion_rate")
    return metric_table(table(spark, sf_dir, "orders"), metric)


@check(
    """SELECT l_partkey, ROUND(sum(l_extendedprice), 2) AS revenue FROM lineitem
       GROUP BY l_partkey ORDER BY revenue DESC, l_partkey LIMIT 10"""
)
def gold_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = cents(group_table(table(spark, sf_dir, "lineitem"), REVENUE_BY_PRODUCT), "revenue")
    return top_n(revenue, ["revenue DESC", "l_partkey ASC"], 10)


LINE_GROUPS = (
    GroupSpec("by_part", [AggSpec("l_extendedprice", "sum", "revenue")], ["l_partkey"]),
    GroupSpec("by_flag", [AggSpec("l_extendedprice", "sum", "revenue"),
                          AggSpec("l_quantity", "min", "least")],
              ["l_returnflag", "l_linestatus"]),
    GroupSpec("by_day", [AggSpec("*", "count", "lines")], date_column="l_shipdate"),
)


@check(
    """SELECT CAST(GROUPING(l_partkey, l_returnflag, l_linestatus, day) AS BIGINT) AS set_code,
              l_partkey, l_returnflag, l_linestatus, day,
              ROUND(sum(l_extendedprice), 2) AS revenue, min(l_quantity) AS least,
              count(*) AS lines
       FROM (SELECT *, CAST(l_shipdate AS DATE) AS day FROM lineitem) l
       GROUP BY GROUPING SETS ((l_partkey), (l_returnflag, l_linestatus), (day))"""
)
def gold_fused_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three grouped outputs from one scan."""
    fused = fused_groups(table(spark, sf_dir, "lineitem"), LINE_GROUPS)
    return fused.select(
        F.col(OUTPUT).alias("set_code"),
        F.col("__key_l_partkey").alias("l_partkey"),
        F.col("__key_l_returnflag").alias("l_returnflag"),
        F.col("__key_l_linestatus").alias("l_linestatus"),
        F.col("__day_l_shipdate").alias("day"),
        F.round("__m0", 2).alias("revenue"),
        F.col("__m1").alias("least"),
        F.col("__m2").alias("lines"),
    )


# Two measures whose function and column read alike when joined, and one key in two spellings.
ALIKE_GROUPS = (
    GroupSpec("by_flag", [AggSpec("if_big", "count", "marked"), AggSpec("big", "count_if", "big")],
              ["l_returnflag"]),
    GroupSpec("by_both", [AggSpec("big", "count_if", "big"), AggSpec("IF_BIG", "count", "marked")],
              ["L_ReturnFlag", "l_linestatus"]),
    GroupSpec("by_day", [AggSpec("l_quantity", "sum", "big"), AggSpec("*", "count", "marked")],
              date_column="L_SHIPDATE"),
)


@check(
    """WITH l AS (SELECT *, l_quantity > 25 AS big,
                         CASE WHEN l_discount > 0.05 THEN 'x' END AS if_big FROM lineitem)
       SELECT 'by_flag' AS output, l_returnflag AS key, count(if_big) AS marked,
              CAST(count_if(big) AS DOUBLE) AS big FROM l GROUP BY ALL
       UNION ALL SELECT 'by_both', l_returnflag || l_linestatus, count(if_big),
              CAST(count_if(big) AS DOUBLE) FROM l GROUP BY ALL
       UNION ALL SELECT 'by_day', CAST(CAST(l_shipdate AS DATE) AS VARCHAR), count(*),
              CAST(sum(l_quantity) AS DOUBLE) FROM l GROUP BY ALL"""
)
def gold_fused_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each output of one scan taken out again."""
    lines = table(spark, sf_dir, "lineitem").withColumns({
        "big": F.col("l_quantity") > 25, "if_big": F.when(F.col("l_discount") > 0.05, "x")})
    fused = fused_groups(lines, ALIKE_GROUPS)
    tables = [
        rows_of(fused, ALIKE_GROUPS, group).select(
            F.lit(group.name).alias("output"),
            F.concat(*[F.col(k).cast("string") for k in group.keys]).alias("key"),
            "marked", F.col("big").cast("double").alias("big"))
        for group in ALIKE_GROUPS
    ]
    return union_all(*tables)


@check(DAILY_SQL)
def gold_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A daily table stored in one directory per year of data, read back in declared order."""
    out = workspace(spark, sf_dir, "gold_partitioned")
    daily = cents(group_table(table(spark, sf_dir, "orders"), DAILY), "daily_revenue")
    by_year = daily.withColumn("year", F.year("date"))
    write_table(by_year, SinkSpec(out, partition_by=["year"]))
    return read_layer(spark, out).select("date", "daily_revenue")


@check(
    """SELECT l_partkey, l_returnflag, ROUND(sum(l_extendedprice), 2) AS revenue
       FROM lineitem GROUP BY 1, 2"""
)
def gold_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = workspace(spark, sf_dir, "gold_clustered")
    group = GroupSpec(
        "revenue", [AggSpec("l_extendedprice", "sum", "revenue")], ["l_partkey", "l_returnflag"]
    )
    totals = cents(group_table(table(spark, sf_dir, "lineitem"), group), "revenue")
    write_table(totals, SinkSpec(out, cluster_by=["l_partkey", "l_returnflag"]))
    return read_layer(spark, out)


def _warehouse_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    daily = cents(group_table(table(spark, sf_dir, "orders"), DAILY), "daily_revenue")
    sink = SinkSpec(
        workspace(spark, sf_dir, name), table=f"trilode_{name}", mode="WRITE_TRUNCATE"
    )
    spark.sql(f"DROP TABLE IF EXISTS {sink.table}")
    write_table(daily, sink)
    return sink.table


@check(DAILY_SQL)
def gold_warehouse_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table written with a warehouse disposition."""
    return spark.table(_warehouse_table(spark, sf_dir, "gold_warehouse_table"))


@check(f"{DAILY_SQL} ORDER BY date DESC LIMIT 10")
def gold_readback_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _warehouse_table(spark, sf_dir, "gold_readback_sql")
    return spark.sql(f"SELECT * FROM {name} ORDER BY date DESC LIMIT 10")


@check(
    """SELECT l_returnflag, ROUND(sum(l_extendedprice), 2) AS revenue
       FROM lineitem GROUP BY l_returnflag"""
)
def gold_text_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One output written as CSV, then as JSON from there."""
    folder = workspace(spark, sf_dir, "gold_text_sinks")
    group = GroupSpec("r", [AggSpec("l_extendedprice", "sum", "revenue")], ["l_returnflag"])
    totals = cents(group_table(table(spark, sf_dir, "lineitem"), group), "revenue")
    ddl = "l_returnflag string, revenue double"
    write_table(totals, SinkSpec(f"{folder}/csv", format="csv", options={"header": "true"}))
    from_csv = spark.read.schema(ddl).option("header", "true").csv(f"{folder}/csv")
    write_table(from_csv, SinkSpec(f"{folder}/json", format="json"))
    return spark.read.schema(ddl).json(f"{folder}/json")


@check(
    """WITH parts AS (SELECT 'old' AS run, * FROM orders WHERE o_orderkey % 2 = 0
                      UNION ALL SELECT 'new' AS run, * FROM orders)
       SELECT run, 'by_status' AS output, o_orderstatus AS key, count(*) AS orders FROM parts GROUP BY ALL
       UNION ALL SELECT run, 'total', NULL, count(*) FROM parts GROUP BY ALL"""
)
def gold_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after a run that failed over new rows, and then after one that did not."""
    root = f"{workspace(spark, sf_dir, 'gold_published')}/{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders")
    flow = FlowSpec(
        "orders", root, "raw", "clean", "totals", FileSource(f"{root}/landing", "parquet"),
        outputs=[MetricSpec("total", "count(*)", "orders"),
                 GroupSpec("by_status", [AggSpec("*", "count", "orders")], ["o_orderstatus"])],
        publish=True,
    )
    broken = MetricSpec("broken", "count(*) + CAST(raise_error('broken') AS bigint)", "broken")

    def seen(run_name: str) -> list[DataFrame]:
        tables = read_outputs(spark, flow)
        return [
            table.select(F.lit(run_name).alias("run"), F.lit(name).alias("output"),
                         key.cast("string").alias("key"), "orders")
            for name, table, key in (
                ("total", tables["total"], F.lit(None)),
                ("by_status", tables["by_status"], F.col("o_orderstatus")))
        ]

    write_table(orders.where("o_orderkey % 2 = 0"), SinkSpec(flow.source.path))
    run(spark, flow)
    write_table(orders, SinkSpec(flow.source.path))
    run(spark, flow.override(outputs=[*flow.outputs, broken]))
    old = seen("old")
    run(spark, flow)
    return union_all(*old, *seen("new"))  # the old run can still be read
