"""The driver's tables hold no dirt, so it is put in by expressions that mean the same in both
engines. Each constant is a SELECT over one of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trilode.checks.registry import table

# orders with NULL status, NULL flags, future dates
ORDERS = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
       CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 97 = 0 END AS fraud_flag,
       CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL '60' YEAR ELSE o_orderdate END
         AS order_date
FROM orders
"""

# events with numbers and times as text, some malformed, and NULL values
EVENTS = """
SELECT event_id, user_id, event_type,
       CASE WHEN event_id % 20 = 0 THEN 'abc' ELSE CAST(value AS VARCHAR(32)) END AS value_text,
       CASE WHEN event_id % 30 = 0 THEN 'x' ELSE CAST(ts AS VARCHAR(32)) END AS ts_text,
       CASE WHEN event_id % 25 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 25 = 5 THEN NULL ELSE event_type END AS kind
FROM events
"""

# customers with e-mail addresses, some broken
CUSTOMERS = """
SELECT c_custkey, c_acctbal,
       CASE WHEN c_custkey % 7 = 0 THEN 'bad'
            ELSE concat('u', c_custkey, '@example.com') END AS email
FROM customer
"""

# sales rows as text, from lineitem: every kind of dirt and exact copies
SALES_BASE = """
SELECT CASE WHEN l_orderkey % 30 = 0 THEN 'x'
            WHEN l_orderkey % 30 = 10
              THEN CAST(CAST(l_shipdate + INTERVAL '60' YEAR AS DATE) AS VARCHAR(10))
            ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) END AS transaction_date,
       CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR(20)) END
         AS product_id,
       CASE WHEN l_suppkey % 7 = 0 THEN 'bad'
            ELSE concat('u', l_suppkey, '@example.com') END AS customer_email,
       CASE WHEN l_orderkey % 20 = 3 THEN 'abc' WHEN l_orderkey % 20 = 4 THEN '-1.5'
            ELSE CAST(l_extendedprice AS VARCHAR(32)) END AS amount,
       CASE WHEN l_linenumber = 3 THEN '-1.0' ELSE CAST(l_quantity AS VARCHAR(32)) END
         AS quantity,
       l_returnflag AS region,
       l_orderkey AS origin
FROM lineitem
"""
SALES = f"""
SELECT transaction_date, product_id, customer_email, amount, quantity, region
FROM ({SALES_BASE}) base
UNION ALL
SELECT transaction_date, product_id, customer_email, amount, quantity, region
FROM ({SALES_BASE}) base WHERE origin % 100 = 7
"""

# sensor readings from events
SENSORS_BASE = """
SELECT CASE WHEN event_id % 40 = 1 THEN NULL ELSE CAST(user_id AS VARCHAR(20)) END AS device_id,
       CASE WHEN event_id % 30 = 0 THEN 'x' ELSE CAST(ts AS VARCHAR(32)) END AS timestamp,
       CASE WHEN event_id % 20 = 0 THEN 'abc' ELSE CAST(value AS VARCHAR(32)) END
         AS temperature,
       CASE WHEN event_id % 25 = 0 THEN NULL ELSE CAST(value AS VARCHAR(32)) END
         AS humidity,
       CASE WHEN event_id % 35 = 0 THEN NULL ELSE CAST(value * 2 AS FLOAT) END AS pressure,
       CAST(regexp_extract(props, '[0-9]+', 0) AS INT)
         + CASE WHEN event_id % 45 = 0 THEN 50 ELSE 0 END AS battery_level,
       event_id AS origin
FROM events
"""
SENSORS = f"""
SELECT device_id, timestamp, temperature, humidity, pressure, battery_level
FROM ({SENSORS_BASE}) base
UNION ALL
SELECT device_id, timestamp, temperature, humidity, pressure, battery_level
FROM ({SENSORS_BASE}) base WHERE origin % 100 = 7
"""

# financial transactions from orders
TRANSACTIONS_BASE = """
SELECT CAST(o_orderkey AS VARCHAR(20)) AS transaction_id,
       CASE WHEN o_custkey % 60 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR(20)) END
         AS account_id,
       CASE WHEN o_orderkey % 30 = 0 THEN 'x' ELSE CAST(o_orderdate AS VARCHAR(32)) END
         AS transaction_date,
       CASE WHEN o_orderkey % 40 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
       CASE o_orderkey % 5 WHEN 0 THEN 'DEPOSIT' WHEN 1 THEN 'WITHDRAWAL'
            WHEN 2 THEN 'TRANSFER' WHEN 3 THEN 'PAYMENT'
            ELSE CASE WHEN o_orderkey % 15 = 4 THEN 'REFUND' ELSE 'PAYMENT' END END
         AS transaction_type,
       CASE WHEN o_orderkey % 50 = 1 THEN NULL
            ELSE CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'PENDING'
                                    ELSE 'FAILED' END END AS status,
       o_orderpriority AS merchant_category,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 97 = 0 END AS fraud_flag,
       o_orderkey AS origin
FROM orders
"""
TRANSACTIONS = f"""
SELECT transaction_id, account_id, transaction_date, amount, transaction_type, status,
       merchant_category, fraud_flag
FROM ({TRANSACTIONS_BASE}) base
UNION ALL
SELECT transaction_id, account_id, transaction_date, amount, transaction_type, status,
       merchant_category, fraud_flag
FROM ({TRANSACTIONS_BASE}) base WHERE origin % 100 = 7
"""

# web log lines from events
WEB_LOGS = """
SELECT CASE WHEN event_id % 30 = 0 THEN NULL ELSE concat('10.0.0.', user_id % 256) END AS ip,
       CASE WHEN event_id % 45 = 1 THEN NULL ELSE ts END AS timestamp,
       CASE WHEN event_id % 50 = 2 THEN NULL
            ELSE CAST(90 + event_id % 600 AS INT) END AS status_code,
       event_id
FROM events
"""

_TABLES = ("orders", "events", "customer", "lineitem")


def dirty(spark: SparkSession, sf_dir: str, select: str) -> DataFrame:
    """Run one of the SELECTs above over the tables of a scale."""
    named = {name: table(spark, sf_dir, name) for name in _TABLES if f"FROM {name}\n" in select}
    text = select.replace("{", "{{").replace("}", "}}")
    for name in named:
        text = text.replace(f"FROM {name}\n", f"FROM {{{name}}}\n")
    return spark.sql(text, **named)
