"""Whole flows: dirty rows land as files, every Gold table is compared.

The outputs come back in one long table ``(output, key, measure, value)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.checks.dirt import SALES, SENSORS, TRANSACTIONS, dirty
from trilode.checks.registry import check, workspace
from trilode.checks.silver import SALES_ORDER, SALES_SILVER
from trilode.operators import union_all
from trilode.plans.domains import fintech, iot, sales
from trilode.plans.run import run
from trilode.sinks import write_table
from trilode.sources import read_layer
from trilode.spec import FileSource, FlowSpec, GroupSpec, SinkSpec, Source


# Sums are compared to the cent. Means get the digits their size allows.
DIGITS = {
    "avg_order_value": 4, "avg_transaction_value": 4, "completion_rate": 9,
    "avg_temperature": 11, "avg_humidity": 11, "avg_temp": 11, "hourly_avg_temp": 11,
}


def long_form(spark: SparkSession, flow: FlowSpec) -> DataFrame:
    parts = []
    for output in flow.outputs:
        gold = read_layer(spark, flow.gold_path(output.name))
        if isinstance(output, GroupSpec):
            key, aliases = F.col(output.keys[0]), [a.alias for a in output.aggregates]
        else:
            key, aliases = F.lit(None), [output.alias]
        parts += [
            gold.select(
                F.lit(output.name).alias("output"),
                key.cast("string").alias("key"),
                F.lit(alias).alias("measure"),
                F.round(F.col(alias).cast("double"), DIGITS.get(alias, 2)).alias("value"),
            )
            for alias in aliases
        ]
    return union_all(*parts)


def run_flow(
    spark: SparkSession,
    sf_dir: str,
    build: Callable[[str, Source], FlowSpec],
    rows: str,
    fmt: str,
    schema: str,
    order: tuple[str, ...],
) -> DataFrame:
    root = workspace(spark, sf_dir, f"domain_{build.__name__}")
    landing = f"{root}/landing"
    options = {"header": "true"} if fmt == "csv" else {}
    write_table(dirty(spark, sf_dir, rows), SinkSpec(landing, format=fmt, options=options))
    flow = build(root, FileSource(landing, fmt, options, schema=schema))
    # exact copies aside, the survivor of a key is arbitrary; an order makes it comparable
    flow = flow.override(cleaning=replace(flow.cleaning, dedup_order=order))
    for result in run(spark, flow).values():
        if not result.success:
            raise RuntimeError(f"{result.layer}: {result.error}")
    return long_form(spark, flow)


def _metric(output: str, sql: str) -> str:
    return (
        f"SELECT '{output}' AS output, CAST(NULL AS VARCHAR) AS key, '{output}' AS measure, "
        f"ROUND(CAST({sql} AS DOUBLE), {DIGITS.get(output, 2)}) AS value FROM silver"
    )


def _group(output: str, key: str, measure: str, sql: str) -> str:
    return (
        f"SELECT '{output}' AS output, CAST({key} AS VARCHAR) AS key, '{measure}' AS measure, "
        f"ROUND(CAST({sql} AS DOUBLE), {DIGITS.get(measure, 2)}) AS value "
        f"FROM silver GROUP BY {key}"
    )


def _flow_sql(silver: str, *outputs: str) -> str:
    return f"WITH silver AS ({silver}) " + " UNION ALL ".join(outputs)


@check(
    _flow_sql(
        SALES_SILVER,
        _metric("total_revenue", "sum(amount)"),
        _metric("avg_order_value", "avg(amount)"),
        _group("revenue_by_product", "product_id", "revenue", "sum(amount)"),
        _group("revenue_by_region", "region", "revenue", "sum(amount)"),
        _group("daily_trend", "transaction_date", "daily_revenue", "sum(amount)"),
    )
)
def domain_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "transaction_date string, product_id string, customer_email string, amount string, " \
        "quantity string, region string"
    return run_flow(spark, sf_dir, sales, SALES, "csv", text, SALES_ORDER)


SENSOR_ORDER = ("temperature", "humidity", "pressure", "battery_level")
SENSOR_SILVER = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY device_id, ts
                               ORDER BY {', '.join(SENSOR_ORDER)}) AS rn
  FROM (
    SELECT device_id, TRY_CAST(timestamp AS TIMESTAMP) AS ts,
           coalesce(TRY_CAST(temperature AS DOUBLE), 0) AS temperature,
           coalesce(TRY_CAST(humidity AS DOUBLE), 0) AS humidity,
           coalesce(pressure, 0) AS pressure, battery_level
    FROM ({SENSORS}) raw
  ) typed
  WHERE device_id IS NOT NULL AND ts IS NOT NULL
    AND temperature BETWEEN -50 AND 100 AND humidity BETWEEN 0 AND 100
    AND battery_level BETWEEN 0 AND 100
) ranked
WHERE rn = 1
"""


@check(
    _flow_sql(
        SENSOR_SILVER,
        _metric("avg_temperature", "avg(temperature)"),
        _metric("avg_humidity", "avg(humidity)"),
        _group("temp_by_device", "device_id", "avg_temp", "avg(temperature)"),
        _group("hourly_avg_temp", "CAST(ts AS DATE)", "hourly_avg_temp", "avg(temperature)"),
        _group("low_battery_devices", "device_id", "min_battery", "min(battery_level)"),
    )
)
def domain_iot(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "device_id string, timestamp string, temperature string, humidity string, " \
        "pressure float, battery_level int"
    return run_flow(spark, sf_dir, iot, SENSORS, "json", text, SENSOR_ORDER)


TRANSACTION_ORDER = ("account_id", "transaction_date", "amount", "transaction_type", "status")
TRANSACTION_SILVER = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
                               ORDER BY {', '.join(TRANSACTION_ORDER)}) AS rn
  FROM (
    SELECT transaction_id, account_id, TRY_CAST(transaction_date AS TIMESTAMP)
             AS transaction_date,
           TRY_CAST(amount AS DECIMAL(15,2)) AS amount, transaction_type,
           coalesce(status, 'PENDING') AS status, merchant_category, fraud_flag
    FROM ({TRANSACTIONS}) raw
  ) typed
  WHERE transaction_id IS NOT NULL AND account_id IS NOT NULL
    AND transaction_date IS NOT NULL AND amount IS NOT NULL
    AND amount > 0
    AND transaction_type IN ('DEPOSIT', 'WITHDRAWAL', 'TRANSFER', 'PAYMENT')
    AND status IN ('PENDING', 'COMPLETED', 'FAILED', 'REVERSED')
    AND fraud_flag IS NOT NULL
) ranked
WHERE rn = 1
"""
_DONE = "CASE WHEN status = 'COMPLETED' THEN"


@check(
    _flow_sql(
        TRANSACTION_SILVER,
        _metric("total_revenue", f"sum({_DONE} amount ELSE 0 END)"),
        _metric("avg_transaction_value", f"avg({_DONE} amount ELSE 0 END)"),
        _metric("fraud_count", "sum(CASE WHEN fraud_flag THEN 1 ELSE 0 END)"),
        _metric("completion_rate",
                f"CAST(sum({_DONE} 1 ELSE 0 END) AS DOUBLE) / NULLIF(count(*), 0)"),
        _group("revenue_by_account", "account_id", "total_spent", "sum(amount)"),
        _group("revenue_by_merchant", "merchant_category", "category_revenue", "sum(amount)"),
        _group("daily_transaction_volume", "CAST(transaction_date AS DATE)", "daily_volume",
               "sum(amount)"),
        _group("daily_transaction_volume", "CAST(transaction_date AS DATE)",
               "transaction_count", "count(transaction_id)"),
    )
)
def domain_fintech(spark: SparkSession, sf_dir: str) -> DataFrame:
    ddl = "transaction_id string, account_id string, transaction_date string, amount double, " \
        "transaction_type string, status string, merchant_category string, fraud_flag boolean"
    return run_flow(spark, sf_dir, fintech, TRANSACTIONS, "parquet", ddl, TRANSACTION_ORDER)
