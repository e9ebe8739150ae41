"""Silver and Gold kept up to date by increments, over three drops with late copies."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.checks.bronze import EVENTS_DDL, ORDERS_DDL, TEXT_TIME
from trilode.checks.gold import cents
from trilode.checks.registry import check, table, workspace
from trilode.plans.increment import read_gold, run_increment
from trilode.plans.run import run
from trilode.sinks import write_table
from trilode.sources import read_layer
from trilode.spec import (
    AggSpec,
    CleaningSpec,
    EventSource,
    FlowSpec,
    GroupSpec,
    RuleSpec,
    SinkSpec,
)


def _flow(spark, sf_dir, query: str, ddl: str, cleaning: CleaningSpec, outputs=()) -> FlowSpec:
    root = f"{workspace(spark, sf_dir, query)}/{uuid.uuid4().hex}"
    source = EventSource(f"{root}/landing", "json", TEXT_TIME, schema=ddl, suffix=".json")
    return FlowSpec("drops", root, "raw", "clean", "totals", source, cleaning, outputs)


def _arrive(spark: SparkSession, flow: FlowSpec, drops: list[DataFrame], buckets: int) -> None:
    sink = SinkSpec(flow.source.path, format="json", mode="append", options=TEXT_TIME)
    for drop in drops:
        write_table(drop, sink)
        run(spark, flow, ["bronze"])
        run_increment(spark, flow, buckets)


@check(
    """SELECT event_id, ts, user_id, event_type, props,
              CASE WHEN event_id % 10 = 3 THEN value + 1 ELSE value END AS value
       FROM events WHERE value > 1"""
)
def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth event comes again with a greater value, and another tenth as it was."""
    events = table(spark, sf_dir, "events")
    flow = _flow(spark, sf_dir, "silver_incremental", EVENTS_DDL, CleaningSpec(
        rules=[RuleSpec("value", "value > 1")], dedup_keys=["event_id"], dedup_order=["value DESC"]))
    greater = events.where("event_id % 10 = 3 AND value > 1").withColumn("value", F.expr("value + 1"))
    _arrive(spark, flow, [
        events.where("event_id % 3 = 0"),
        events.where("event_id % 3 = 1 OR event_id % 10 = 5").unionByName(
            greater.where("event_id % 3 <> 1")),
        events.where("event_id % 3 = 2 OR event_id % 10 = 7").unionByName(
            greater.where("event_id % 3 = 1")),
    ], 16)
    return read_layer(spark, flow.silver_path).select(
        "event_id", "ts", "user_id", "event_type", "value", "props")


@check(
    """SELECT CAST(o_orderdate AS DATE) AS date, ROUND(sum(o_totalprice), 2) AS daily_volume,
              count(o_orderkey) AS transaction_count, count(*) AS row_count,
              min(o_totalprice) AS least, max(o_totalprice) AS most,
              avg(o_custkey) AS mean
       FROM orders GROUP BY 1"""
)
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily volume, put together from what each drop added to Silver."""
    orders = table(spark, sf_dir, "orders")
    group = GroupSpec(
        "daily_volume",
        [AggSpec("o_totalprice", "sum", "daily_volume"),
         AggSpec("o_orderkey", "count", "transaction_count"),
         AggSpec("*", "count", "row_count"), AggSpec("o_totalprice", "min", "least"),
         AggSpec("o_totalprice", "max", "most"), AggSpec("o_custkey", "avg", "mean")],
        date_column="o_orderdate", sort=["date ASC"],
    )
    flow = _flow(spark, sf_dir, "gold_incremental", ORDERS_DDL,
                 CleaningSpec(dedup_keys=["o_orderkey"]), [group])
    _arrive(spark, flow, [
        orders.where("o_orderkey % 3 = 0"),
        orders.where("o_orderkey % 3 = 1 OR o_orderkey % 10 = 5"),
        orders.where("o_orderkey % 3 = 2 OR o_orderkey % 10 = 7"),
    ], 16)
    return cents(read_gold(spark, flow, "daily_volume"), "daily_volume")
