"""Ready-made flows: sales, IoT sensors, financial transactions, web logs.

Fixed values: the table and column names, rules, thresholds, defaults and outputs below.
"""

from __future__ import annotations

from collections.abc import Callable

from trilode.functions.predicates import EMAIL_PATTERN
from trilode.spec import (
    AggSpec,
    CleaningSpec,
    FileSource,
    FlowSpec,
    GroupSpec,
    MetricSpec,
    RuleSpec,
    Source,
)

# ---------------------------------------------------------------- sales

SALES_COLUMNS = (
    "transaction_date", "product_id", "customer_email", "amount", "quantity", "region",
    "ingestion_timestamp",
)

SALES_CLEANING = CleaningSpec(
    type_fixes={
        "transaction_date": "try_cast(transaction_date AS DATE)",
        "quantity": "try_cast(try_cast(quantity AS DOUBLE) AS INT)",
        "amount": "try_cast(amount AS DOUBLE)",
    },
    null_drop=("product_id", "customer_email"),
    rules=(
        RuleSpec("transaction_date", "transaction_date <= current_date()", "No future dates"),
        RuleSpec("amount", "amount > 0", "Positive amounts only"),
        RuleSpec("quantity", "quantity >= 1 AND quantity <= 100", "Quantity between 1-100"),
        RuleSpec("customer_email", f"customer_email RLIKE r'{EMAIL_PATTERN}'",
                 "Valid email format"),
    ),
    dedup_keys=("transaction_date", "product_id", "customer_email", "amount"),
)

SALES_OUTPUTS = (
    MetricSpec("total_revenue", "sum(amount)", "total_revenue"),
    MetricSpec("avg_order_value", "avg(amount)", "avg_order_value"),
    GroupSpec("revenue_by_product", [AggSpec("amount", "sum", "revenue")], ["product_id"],
              sort=["revenue DESC"]),
    GroupSpec("revenue_by_region", [AggSpec("amount", "sum", "revenue")], ["region"],
              sort=["revenue DESC"]),
    GroupSpec("daily_trend", [AggSpec("amount", "sum", "daily_revenue")],
              date_column="transaction_date", sort=["date ASC"]),
)


def sales(root: str, source: Source | None = None) -> FlowSpec:
    return FlowSpec(
        domain="Sales Analytics",
        root=root,
        bronze_table="sales_raw",
        silver_table="sales_clean",
        gold_table="sales_aggregated",
        source=source or FileSource(
            "data/raw/", "csv", {"header": "true", "inferSchema": "true", "delimiter": ","}
        ),
        cleaning=SALES_CLEANING,
        outputs=SALES_OUTPUTS,
        columns=SALES_COLUMNS,
    )


# ---------------------------------------------------------------- IoT sensors

IOT_COLUMNS = (
    "device_id", "timestamp", "temperature", "humidity", "pressure", "battery_level",
)

IOT_CLEANING = CleaningSpec(
    type_fixes={
        "timestamp": "try_cast(timestamp AS TIMESTAMP)",
        "temperature": "try_cast(temperature AS DOUBLE)",
        "humidity": "try_cast(humidity AS DOUBLE)",
    },
    null_drop=("device_id", "timestamp"),
    null_fill={"temperature": "0", "humidity": "0", "pressure": "0"},
    rules=(
        RuleSpec("temperature", "temperature >= -50 AND temperature <= 100",
                 "Valid temperature range"),
        RuleSpec("humidity", "humidity >= 0 AND humidity <= 100", "Valid humidity range"),
        RuleSpec("battery_level", "battery_level >= 0 AND battery_level <= 100",
                 "Valid battery level"),
    ),
    dedup_keys=("device_id", "timestamp"),
)

IOT_OUTPUTS = (
    MetricSpec("avg_temperature", "avg(temperature)", "avg_temperature"),
    MetricSpec("avg_humidity", "avg(humidity)", "avg_humidity"),
    GroupSpec("temp_by_device", [AggSpec("temperature", "avg", "avg_temp")], ["device_id"],
              sort=["avg_temp DESC"]),
    # daily, whatever its name says; grain="hour" gives the hourly trend
    GroupSpec("hourly_avg_temp", [AggSpec("temperature", "avg", "hourly_avg_temp")],
              date_column="timestamp", sort=["date ASC"]),
    GroupSpec("low_battery_devices", [AggSpec("battery_level", "min", "min_battery")],
              ["device_id"], sort=["min_battery ASC"]),
)


def iot(root: str, source: Source | None = None) -> FlowSpec:
    return FlowSpec(
        domain="IoT Sensors",
        root=root,
        bronze_table="sensor_raw",
        silver_table="sensor_clean",
        gold_table="sensor_aggregated",
        source=source or FileSource("data/raw/sensors/", "json", {"multiLine": "true"}),
        cleaning=IOT_CLEANING,
        outputs=IOT_OUTPUTS,
        columns=IOT_COLUMNS,
    )


# ---------------------------------------------------------------- financial transactions

FINTECH_COLUMNS = (
    "transaction_id", "account_id", "transaction_date", "amount", "transaction_type", "status",
    "merchant_category", "fraud_flag",
)

FINTECH_CLEANING = CleaningSpec(
    type_fixes={
        "transaction_date": "try_cast(transaction_date AS TIMESTAMP)",
        "amount": "try_cast(amount AS DECIMAL(15,2))",
    },
    null_drop=("transaction_id", "account_id", "transaction_date", "amount"),
    null_fill={"status": "'PENDING'"},
    rules=(
        RuleSpec("amount", "amount > 0", "Amount must be positive"),
        RuleSpec("transaction_type",
                 "transaction_type IN ('DEPOSIT', 'WITHDRAWAL', 'TRANSFER', 'PAYMENT')",
                 "Valid transaction type"),
        RuleSpec("status", "status IN ('PENDING', 'COMPLETED', 'FAILED', 'REVERSED')",
                 "Valid status"),
        RuleSpec("fraud_flag", "fraud_flag IN (true, false)", "Fraud flag must be boolean"),
    ),
    dedup_keys=("transaction_id",),
)

FINTECH_OUTPUTS = (
    MetricSpec("total_revenue", "sum(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END)",
               "total_revenue"),
    MetricSpec("avg_transaction_value",
               "avg(CASE WHEN status = 'COMPLETED' THEN amount ELSE 0 END)",
               "avg_transaction_value"),
    MetricSpec("fraud_count", "sum(CASE WHEN fraud_flag = true THEN 1 ELSE 0 END)",
               "fraud_count"),
    GroupSpec("revenue_by_account", [AggSpec("amount", "sum", "total_spent")], ["account_id"],
              sort=["total_spent DESC"]),
    GroupSpec("revenue_by_merchant", [AggSpec("amount", "sum", "category_revenue")],
              ["merchant_category"], sort=["category_revenue DESC"]),
    GroupSpec("daily_transaction_volume",
              [AggSpec("amount", "sum", "daily_volume"),
               AggSpec("transaction_id", "count", "transaction_count")],
              date_column="transaction_date", sort=["date ASC"]),
    MetricSpec("completion_rate",
               "try_divide(sum(CASE WHEN status = 'COMPLETED' THEN 1 ELSE 0 END), count(*))",
               "completion_rate"),
)


def fintech(root: str, source: Source | None = None) -> FlowSpec:
    return FlowSpec(
        domain="Financial Transactions",
        root=root,
        bronze_table="transactions_raw",
        silver_table="transactions_clean",
        gold_table="financial_aggregated",
        source=source or FileSource("data/raw/transactions/", "parquet"),
        cleaning=FINTECH_CLEANING,
        outputs=FINTECH_OUTPUTS,
        columns=FINTECH_COLUMNS,
    )


# ---------------------------------------------------------------- web logs

WEB_LOG_CLEANING = CleaningSpec(
    null_drop=("ip", "timestamp"),
    rules=(RuleSpec("status_code", "status_code BETWEEN 100 AND 599", "Valid status code"),),
)


def web_logs(root: str, source: Source | None = None) -> FlowSpec:
    return FlowSpec(
        domain="Web Logs",
        root=root,
        bronze_table="web_raw",
        silver_table="web_clean",
        gold_table="web_aggregated",
        source=source or FileSource("data/raw/web/", "json"),
        cleaning=WEB_LOG_CLEANING,
        columns=("ip", "timestamp", "status_code"),
    )


DOMAINS: dict[str, Callable[..., FlowSpec]] = {
    "sales": sales,
    "iot": iot,
    "fintech": fintech,
    "web_logs": web_logs,
}
