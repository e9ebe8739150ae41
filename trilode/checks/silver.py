"""One cleaning step at a time, then all of them."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode import functions as T
from trilode.checks.dirt import CUSTOMERS, EVENTS, ORDERS, SALES, WEB_LOGS, dirty
from trilode.checks.registry import check, table, workspace
from trilode.functions.column_text import as_sql
from trilode.operators import (
    apply_rules,
    clean,
    dedup,
    drop_nulls,
    fill_nulls,
    fix_types,
    union_all,
)
from trilode.operators import select_columns
from trilode.plans.domains import SALES_CLEANING, WEB_LOG_CLEANING
from trilode.plans.run import run
from trilode.sources import read_layer
from trilode.spec import CatalogSource, CleaningSpec, FlowSpec, RuleSpec


@check("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def silver_column_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return select_columns(lineitem, ["l_orderkey", "l_linenumber", "l_quantity"])


@check(f"SELECT * FROM ({ORDERS}) o WHERE status IS NOT NULL AND fraud_flag IS NOT NULL")
def silver_null_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_nulls(dirty(spark, sf_dir, ORDERS), ["status", "fraud_flag"])


@check(
    f"""SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 0 ELSE coalesce(value, 0) END AS value,
               coalesce(kind, 'PENDING') AS kind
        FROM ({EVENTS}) e"""
)
def silver_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs of two columns, and NaN in one of them for every ninth event."""
    events = dirty(spark, sf_dir, EVENTS).select(
        "event_id", F.when(F.col("event_id") % 9 == 0, F.lit("NaN").cast("double"))
        .otherwise(F.col("value")).alias("value"), "kind")
    return fill_nulls(events, {"value": "0", "kind": "'PENDING'"})


@check(
    f"""SELECT event_id,
               TRY_CAST(value_text AS DOUBLE) AS as_double,
               CAST(trunc(TRY_CAST(value_text AS DOUBLE)) AS INT) AS as_int,
               CAST(trunc(TRY_CAST(value_text AS DOUBLE)) AS BIGINT) AS as_long,
               TRY_CAST(value_text AS DECIMAL(15,2)) AS as_decimal,
               CAST(TRY_CAST(ts_text AS TIMESTAMP) AS DATE) AS as_day,
               TRY_CAST(ts_text AS TIMESTAMP) AS as_moment
        FROM ({EVENTS}) e"""
)
def silver_type_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("value_text")
    events = dirty(spark, sf_dir, EVENTS).select(
        "event_id",
        *[text.alias(c) for c in ("as_double", "as_int", "as_long", "as_decimal")],
        F.col("ts_text").alias("as_day"),
        F.col("ts_text").alias("as_moment"),
    )
    fixed = fix_types(
        events,
        {
            "as_double": T.to_double("as_double"),
            "as_int": T.to_int("as_int"),
            "as_long": T.to_long("as_long"),
            "as_decimal": T.to_decimal("as_decimal", 15, 2),
            "as_day": T.to_day("as_day"),
            "as_moment": T.to_moment("as_moment"),
        },
    )
    return fixed.withColumn("as_moment", F.col("as_moment").cast("timestamp_ntz"))


@check("SELECT * FROM lineitem WHERE l_quantity >= 10 AND l_quantity <= 40")
def silver_rule_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = T.at_least("l_quantity", 10) & T.at_most("l_quantity", 40)
    return apply_rules(table(spark, sf_dir, "lineitem"), [RuleSpec("l_quantity", rule)])


@check("SELECT * FROM lineitem WHERE l_quantity BETWEEN 5 AND 20")
def silver_rule_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [RuleSpec("l_quantity", T.within("l_quantity", 5, 20))]
    return apply_rules(table(spark, sf_dir, "lineitem"), rules)


@check(f"SELECT * FROM ({ORDERS}) o WHERE status IN ('F', 'O')")
def silver_rule_isin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [RuleSpec("status", T.one_of("status", ["F", "O"]))]
    return apply_rules(dirty(spark, sf_dir, ORDERS), rules)


@check("SELECT * FROM customer WHERE c_acctbal > 0")
def silver_rule_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [RuleSpec("c_acctbal", T.positive("c_acctbal"))]
    return apply_rules(table(spark, sf_dir, "customer"), rules)


@check(f"SELECT * FROM ({ORDERS}) o WHERE status = 'F'")
def silver_rule_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [RuleSpec("status", T.equals("status", "F"))]
    return apply_rules(dirty(spark, sf_dir, ORDERS), rules)


@check(f"SELECT * FROM ({CUSTOMERS}) c WHERE regexp_matches(email, '{T.EMAIL_PATTERN}')")
def silver_rule_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [RuleSpec("email", T.matches("email"))]
    return apply_rules(dirty(spark, sf_dir, CUSTOMERS), rules)


@check(f"SELECT * FROM ({ORDERS}) o WHERE order_date <= current_date")
def silver_rule_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [RuleSpec("order_date", T.not_future("order_date"))]
    return apply_rules(dirty(spark, sf_dir, ORDERS), rules)


@check(f"SELECT * FROM ({ORDERS}) o WHERE fraud_flag IS NOT NULL")
def silver_rule_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [RuleSpec("fraud_flag", T.is_flag("fraud_flag"))]
    return apply_rules(dirty(spark, sf_dir, ORDERS), rules)


LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_ORDER = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


@check(
    f"""SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEY)}
                                       ORDER BY {', '.join(LINE_ORDER)}) AS rn
          FROM lineitem) l
        WHERE rn = 1"""
)
def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


@check("SELECT * FROM orders")
def silver_dedup_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An arbitrary survivor of whole rows; copies are exact, so that all columns can be compared."""
    orders = table(spark, sf_dir, "orders")
    return dedup(union_all(orders, orders.where("o_orderkey % 100 = 7")), ["o_orderkey"])


SALES_ORDER = ("quantity", "region")

# Silver of the sales rows, for the oracles of this layer and the next
SALES_SILVER = f"""
SELECT transaction_date, product_id, customer_email, amount, quantity, region
FROM (
  SELECT *, row_number() OVER (
           PARTITION BY transaction_date, product_id, customer_email, amount
           ORDER BY quantity, region) AS rn
  FROM (
    SELECT TRY_CAST(transaction_date AS DATE) AS transaction_date, product_id, customer_email,
           TRY_CAST(amount AS DOUBLE) AS amount,
           CAST(trunc(TRY_CAST(quantity AS DOUBLE)) AS INT) AS quantity, region
    FROM ({SALES}) raw
  ) typed
  WHERE product_id IS NOT NULL AND customer_email IS NOT NULL
    AND transaction_date <= current_date AND amount > 0 AND quantity >= 1 AND quantity <= 100
    AND regexp_matches(customer_email, '{T.EMAIL_PATTERN}')
) ranked
WHERE rn = 1
"""


@check(SALES_SILVER)
def silver_clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = replace(SALES_CLEANING, dedup_order=SALES_ORDER)
    return clean(dirty(spark, sf_dir, SALES), spec)


@check(
    f"""SELECT * FROM ({WEB_LOGS}) w
        WHERE ip IS NOT NULL AND timestamp IS NOT NULL AND status_code BETWEEN 100 AND 599"""
)
def silver_clean_web_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(dirty(spark, sf_dir, WEB_LOGS), WEB_LOG_CLEANING)


LINE_CLEANING = CleaningSpec(
    type_fixes={"l_quantity": "try_cast(try_cast(l_quantity AS DOUBLE) AS INT)"},
    null_drop=("l_partkey", "l_suppkey"),
    rules=(
        RuleSpec("l_quantity", "l_quantity BETWEEN 1 AND 100", "Quantity between 1-100"),
        RuleSpec("l_extendedprice", "l_extendedprice > 0", "Positive amounts only"),
    ),
    dedup_keys=LINE_KEY,
    dedup_order=LINE_ORDER,
)

LINE_SILVER = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEY)}
                               ORDER BY {', '.join(LINE_ORDER)}) AS rn
  FROM (SELECT * REPLACE (CAST(trunc(l_quantity) AS INT) AS l_quantity) FROM lineitem) t
  WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL
    AND l_quantity BETWEEN 1 AND 100 AND l_extendedprice > 0) l
WHERE rn = 1
"""


@check(LINE_SILVER)
def silver_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(table(spark, sf_dir, "lineitem"), LINE_CLEANING)


REJECT_FEED = f"SELECT * FROM ({ORDERS}) o UNION ALL SELECT * FROM ({ORDERS}) o WHERE o_orderkey % 100 = 7"
_FAILED = """CAST(CASE WHEN status IS NULL THEN 8 ELSE
        CASE WHEN order_date <= current_date THEN 0 ELSE 1 END
        + CASE WHEN o_totalprice > 100000 THEN 0 ELSE 2 END
        + CASE WHEN fraud_flag IS NULL THEN 4 ELSE 0 END END AS BIGINT) AS failed_rules"""


@check(
    f"""WITH j AS (SELECT *, {_FAILED} FROM ({REJECT_FEED}) r)
        SELECT DISTINCT 'silver' AS side, * FROM j WHERE failed_rules = 0
        UNION ALL SELECT 'quarantine', * FROM j WHERE failed_rules <> 0
        UNION ALL SELECT 'report', failed, NULL, NULL, NULL, NULL, NULL, NULL, total FROM (
            SELECT count(*) FILTER (failed_rules & 1 = 1) AS failed,
                   count(*) FILTER (failed_rules < 8) AS total FROM j)"""
)
def silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run with quarantine writes: Silver, the rejected rows with the rules they broke, and
    the stored report of the first rule."""
    dirty(spark, sf_dir, REJECT_FEED).createOrReplaceTempView("trilode_rejects")
    flow = FlowSpec(
        domain="orders", root=f"{workspace(spark, sf_dir, 'silver_quarantine')}/{uuid.uuid4().hex}",
        bronze_table="raw", silver_table="clean", gold_table="totals",
        source=CatalogSource("SELECT * FROM trilode_rejects"),
        cleaning=CleaningSpec(
            null_drop=["status"], dedup_keys=["o_orderkey"],
            rules=[RuleSpec("order_date", "order_date <= current_date()", "No future dates"),
                   RuleSpec("o_totalprice", "o_totalprice > 100000", "Large orders"),
                   RuleSpec("fraud_flag", "fraud_flag IS NOT NULL", "Flag is set")]),
        quarantine=True,
    )
    run(spark, flow, ["bronze", "silver"], checks=True)
    sides = {"silver": flow.silver_path, "quarantine": flow.quarantine_path}
    tables = [read_layer(spark, path).drop("ingestion_timestamp", "source_query")
              .withColumn("side", F.lit(side)) for side, path in sides.items()]
    report = spark.read.parquet(flow.rules_path).where("position = 1").select(
        F.lit("report").alias("side"), F.col("failed").alias("o_orderkey"),
        F.col("total").alias("failed_rules"))
    return union_all(*tables).unionByName(report, allowMissingColumns=True)


@check(
    """SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS whole,
              upper(substr(o_orderpriority, 1, 3)) AS short, o_custkey * 2 AS long_key
       FROM orders WHERE trunc(o_totalprice) > 100000 AND o_orderstatus IN ('F', 'O')"""
)
def silver_column_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column text in Python notation over columns that arrive as text."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CAST(o_totalprice AS string) AS whole", "o_orderstatus",
        "o_orderpriority AS short", "concat(o_custkey * 2, '.50') AS long_key")
    return clean(orders, CleaningSpec(
        type_fixes={"whole": as_sql("col('whole').cast('int')"),
                    "short": as_sql("upper(col('short').substr(1, 3))"),
                    "long_key": as_sql("col('long_key').cast('bigint')")},
        rules=[RuleSpec("whole", as_sql("col('whole') > 100000")),
               RuleSpec("o_orderstatus", as_sql("col('o_orderstatus').isin(['F', 'O'])"))],
    )).drop("o_orderstatus")
