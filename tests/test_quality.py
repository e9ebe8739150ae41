from datetime import datetime

from helpers import plan, rows, unordered

from trilode.operators import (
    audit_summary,
    bronze_contract,
    clean,
    gold_contract,
    recent_runs,
    row_accounting,
    rule_report,
    silver_contract,
)
from trilode.operators.audit import AUDIT_SCHEMA
from trilode.sources import inline_rows
from trilode.spec import (
    AggSpec,
    CatalogSource,
    CleaningSpec,
    FileSource,
    FlowSpec,
    GroupSpec,
    MetricSpec,
    RuleSpec,
)

RULES = [RuleSpec("n", "n > 0", "positive"), RuleSpec("s", "s = 'x'", "is x")]


def frame(spark, data):
    return spark.createDataFrame(data, "n int, s string")


def test_null_outcome_counts_as_failed(spark):
    report = rule_report(frame(spark, [(1, "x"), (-1, None), (None, "y")]), RULES)
    assert plan(report, "simple").count("Scan") == 1
    assert rows(report) == [(1, "n", "positive", 2, 3), (2, "s", "is x", 2, 3)]


def test_report_without_rules(spark):
    empty = rule_report(frame(spark, [(1, "x")]), [])
    assert rows(empty) == []
    assert empty.dtypes == rule_report(frame(spark, []), RULES).dtypes


def test_report_over_nothing(spark):
    assert rows(rule_report(frame(spark, []), RULES)) == [
        (1, "n", "positive", 0, 0), (2, "s", "is x", 0, 0)]


def test_every_row_is_accounted_for(spark):
    data = [(1, "x"), (1, "x"), (1, "x"), (2, "x"), (None, "x"), (-3, "x"), (5, "q"), (6, None)]
    spec = CleaningSpec(null_drop=["n"], null_fill={"s": "'x'"}, rules=RULES, dedup_keys=["n"])
    df = frame(spark, data)
    assert rows(row_accounting(df, spec)) == [(8, 1, 2, 2, 3)]
    assert clean(df, spec).count() == 3
    assert rows(row_accounting(frame(spark, []), spec)) == [(0, 0, 0, 0, 0)]
    no_keys = CleaningSpec(null_drop=["n"], rules=RULES)
    assert rows(row_accounting(df, no_keys)) == [(8, 1, 3, 0, 4)]


def test_accounting_knows_null_keys(spark):
    spec = CleaningSpec(dedup_keys=["n", "s"])
    df = frame(spark, [(None, None), (None, None), (1, None)])
    assert rows(row_accounting(df, spec)) == [(3, 0, 0, 1, 2)]
    assert clean(df, spec).count() == 2


def test_silver_contract(spark):
    spec = CleaningSpec(null_drop=["n"], dedup_keys=["n", "s"])
    bad = frame(spark, [(1, None), (1, None), (None, "x")])
    assert rows(silver_contract(bad, spec)) == [
        ("silver", "no null n", 1, False), ("silver", "unique key", 1, False)]
    assert all(r.passed for r in silver_contract(clean(bad, spec), spec).collect())
    assert rows(silver_contract(bad, CleaningSpec())) == []


def test_bronze_contract(spark):
    df = spark.sql("SELECT 1 AS ingestion_timestamp, 2 AS source_query")
    assert [r.passed for r in bronze_contract(df, CatalogSource("q")).collect()] == [True, True]
    assert unordered(bronze_contract(df, FileSource("p"))) == [
        ("bronze", "has ingestion_timestamp", 0, True), ("bronze", "has source_file", 1, False)]


def test_gold_contract(spark):
    flow = FlowSpec("d", "r", "b", "s", "g", FileSource("p"), outputs=[
        MetricSpec("m", "sum(n)", "total"), GroupSpec("t", [AggSpec("n", "sum", "v")], ["k"])])
    tables = {"m": spark.sql("SELECT 1 AS total"), "t": spark.sql("SELECT 1 AS k")}
    assert unordered(gold_contract(tables, flow)) == [
        ("gold", "m complete", 0, True), ("gold", "t complete", 1, False)]
    assert unordered(gold_contract({}, flow)) == [
        ("gold", "m complete", 1, False), ("gold", "t complete", 2, False)]


def run_row(run, layer, good, seconds, minute):
    return (run, layer, good, seconds, 1, 1, "p", None if good else "boom",
            datetime(2024, 1, 1, 0, minute))


def test_audit(spark):
    history = inline_rows(spark, [
        run_row("r1", "bronze", True, 1.0, 1), run_row("r1", "silver", False, 2.0, 2),
        run_row("r2", "bronze", True, 3.0, 3), run_row("r2", "silver", True, 2.0, 4)], AUDIT_SCHEMA)
    assert rows(audit_summary(history)) == [(4, 3, 1, 75.0, 8.0, 2.0)]
    assert [(r.run_id, r.layer) for r in recent_runs(history, 3).collect()] == [
        ("r2", "silver"), ("r2", "bronze"), ("r1", "silver")]
    assert rows(audit_summary(history.limit(0))) == [(0, 0, 0, None, 0.0, None)]
