import json
from dataclasses import replace
from pathlib import Path

import pytest
from helpers import rows, unordered

from trilode import run
from trilode.__main__ import chosen_layers, main, parse
from trilode.operators import group_table, metric_table, row_accounting
from trilode.plans.domains import DOMAINS, fintech, iot, sales, web_logs
from trilode.spec import CatalogSource, EventSource, FileSource, IncrementSpec, SinkSpec

SALES = """transaction_date,product_id,customer_email,amount,quantity,region
2024-01-01,p1,a@x.org,10.50,2,North
2024-01-01,p1,a@x.org,10.50,2,North
2024-01-02,p2,b@x.org,20.00,1.9,South
2024-01-02,,b@x.org,20.00,1,South
2024-01-02,p2,broken,20.00,1,South
2999-01-02,p2,b@x.org,20.00,1,South
2024-01-03,p1,c@x.org,-5,1,North
2024-01-03,p1,c@x.org,5,101,North
2024-01-03,p1,c@x.org,oops,1,North
2024-01-04,p3,c@x.org,1.25,100,North
"""


def landing(root, text=SALES, name="sales.csv"):
    folder = Path(root, "raw")
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def sales_flow(root, **options):
    source = FileSource(landing(root), "csv", {"header": "true", "inferSchema": "true"})
    return sales(root, source).override(**options)


def gold(spark, flow, name):
    return spark.read.parquet(flow.gold_path(name))


@pytest.mark.parametrize("fuse", [True, False])
def test_sales_end_to_end(spark, root, fuse):
    flow = sales_flow(root, fuse=fuse)
    results = run(spark, flow)
    assert [(r.layer, r.success, r.input_rows, r.output_rows) for r in results.values()] == [
        ("bronze", True, 10, 10), ("silver", True, 10, 3), ("gold", True, 3, 10)]
    silver = spark.read.parquet(flow.silver_path)
    assert unordered(silver.select("product_id", "amount", "quantity")) == [
        ("p1", 10.5, 2), ("p2", 20.0, 1), ("p3", 1.25, 100)]
    assert rows(gold(spark, flow, "total_revenue")) == [(31.75,)]
    assert gold(spark, flow, "avg_order_value").columns == ["avg_order_value"]
    assert rows(gold(spark, flow, "revenue_by_product")) == [
        ("p2", 20.0), ("p1", 10.5), ("p3", 1.25)]
    for output in flow.groups:
        assert unordered(gold(spark, flow, output.name)) == unordered(group_table(silver, output))
    for output in flow.metrics:
        assert rows(gold(spark, flow, output.name)) == rows(metric_table(silver, output))


def test_rows_add_up(spark, root):
    flow = sales_flow(root)
    run(spark, flow, ["bronze", "silver"])
    account = row_accounting(spark.read.parquet(flow.bronze_path), flow.cleaning).first()
    assert account.bronze == (account.null_dropped + account.rule_failed + account.duplicates
                              + account.silver) == 10
    assert account.silver == spark.read.parquet(flow.silver_path).count()


def test_chain_stops_at_the_first_failure(spark, root):
    flow = sales_flow(root)
    broken = flow.override(cleaning=replace(flow.cleaning, null_drop=("nowhere",)))
    results = run(spark, broken)
    assert list(results) == ["bronze", "silver"]
    assert results["bronze"].success and not results["silver"].success
    assert "nowhere" in results["silver"].error
    audit = spark.read.parquet(flow.audit_path)
    assert unordered(audit.select("layer", "success")) == [("bronze", True), ("silver", False)]
    assert audit.select("run_id").distinct().count() == 1
    assert audit.filter("NOT success").first().output_path == flow.silver_path


def test_missing_columns_fail_before_running(spark, root):
    flow = sales_flow(root).override(columns=("transaction_date", "missing_one"))
    results = run(spark, flow)
    assert "missing_one" in results["silver"].error


def test_layers_run_one_at_a_time(spark, root):
    flow = sales_flow(root)
    for layer in ("bronze", "silver", "gold"):
        assert list(run(spark, flow, [layer], audit=False)) == [layer]
    assert not Path(flow.audit_path).exists()
    with pytest.raises(ValueError):
        run(spark, flow, ["copper"])


def test_reruns_do_not_change_the_tables(spark, root):
    flow = sales_flow(root)
    for _ in range(2):
        run(spark, flow)
    assert spark.read.parquet(flow.bronze_path).count() == 10
    assert rows(gold(spark, flow, "total_revenue")) == [(31.75,)]
    assert spark.read.parquet(flow.audit_path).count() == 6


@pytest.mark.parametrize("fuse", [True, False])
def test_empty_input(spark, root, fuse):
    source = FileSource(landing(root, SALES.splitlines()[0] + "\n"), "csv", {"header": "true"})
    flow = sales(root, source).override(fuse=fuse)
    assert all(r.success for r in run(spark, flow).values())
    assert rows(gold(spark, flow, "total_revenue")) == [(None,)]
    assert gold(spark, flow, "total_revenue").dtypes == [("total_revenue", "double")]
    assert rows(gold(spark, flow, "daily_trend")) == []


def test_iot_from_multi_line_json(spark, root):
    text = """[
      {"device_id": "d1", "timestamp": "2024-01-01 10:00:00", "temperature": 20.5,
       "humidity": 50, "pressure": 1.5, "battery_level": 80},
      {"device_id": "d1", "timestamp": "2024-01-01 10:00:00", "temperature": 20.5,
       "humidity": 50, "pressure": 1.5, "battery_level": 80},
      {"device_id": "d1", "timestamp": "2024-01-01 11:00:00", "temperature": null,
       "humidity": 50, "pressure": null, "battery_level": 70},
      {"device_id": "d2", "timestamp": "2024-01-02 11:00:00", "temperature": 200,
       "humidity": 50, "pressure": 1, "battery_level": 70},
      {"device_id": "d3", "timestamp": "never", "temperature": 20,
       "humidity": 50, "pressure": 1, "battery_level": 70}
    ]"""
    source = FileSource(landing(root, text, "a.json"), "json", {"multiLine": "true"})
    flow = iot(root, source)
    assert all(r.success for r in run(spark, flow).values())
    assert rows(gold(spark, flow, "temp_by_device")) == [("d1", 10.25)]
    assert rows(gold(spark, flow, "low_battery_devices")) == [("d1", 70)]
    assert rows(gold(spark, flow, "avg_temperature")) == [(10.25,)]


def test_fintech_from_parquet(spark, root):
    spark.sql("""
        SELECT * FROM VALUES
          ('t1', 'a1', '2024-01-01', 100.00, 'DEPOSIT', 'COMPLETED', 'm1', true),
          ('t2', 'a1', '2024-01-01', 50.00, 'PAYMENT', NULL, 'm2', false),
          ('t2', 'a1', '2024-01-01', 50.00, 'PAYMENT', NULL, 'm2', false),
          ('t3', 'a2', '2024-01-02', 10.00, 'GIFT', 'FAILED', 'm1', false),
          ('t4', 'a2', '2024-01-02', 10.00, 'PAYMENT', 'FAILED', 'm1', NULL),
          ('t5', NULL, '2024-01-02', 10.00, 'PAYMENT', 'FAILED', 'm1', true)
        AS t(transaction_id, account_id, transaction_date, amount, transaction_type, status,
             merchant_category, fraud_flag)""").write.parquet(f"{root}/raw")
    flow = fintech(root, FileSource(f"{root}/raw", "parquet"))
    assert all(r.success for r in run(spark, flow).values())
    assert spark.read.parquet(flow.silver_path).count() == 2
    assert float(gold(spark, flow, "total_revenue").first()[0]) == 100.0
    assert float(gold(spark, flow, "avg_transaction_value").first()[0]) == 50.0
    assert rows(gold(spark, flow, "fraud_count")) == [(1,)]
    assert rows(gold(spark, flow, "completion_rate")) == [(0.5,)]
    volume = gold(spark, flow, "daily_transaction_volume").first()
    assert (float(volume.daily_volume), volume.transaction_count) == (150.0, 2)


def test_web_logs(spark, root):
    text = ('{"ip": "1.1.1.1", "timestamp": "t", "status_code": 100}\n'
            '{"ip": "1.1.1.1", "timestamp": "t", "status_code": 600}\n'
            '{"ip": null, "timestamp": "t", "status_code": 200}\n')
    flow = web_logs(root, FileSource(landing(root, text, "a.json"), "json"))
    assert run(spark, flow)["silver"].output_rows == 1


def test_stream_source(spark, root):
    ddl = "transaction_date string, product_id string, customer_email string, amount string, " \
        "quantity string, region string"
    source = EventSource(landing(root), "csv", {"header": "true"}, schema=ddl, suffix=".csv",
                         track_file=True)
    flow = sales(root, source)
    assert run(spark, flow)["bronze"].output_rows == 10
    landing(root, SALES, "again.csv")
    results = run(spark, flow)
    assert results["bronze"].output_rows == 10 and results["silver"].input_rows == 20
    assert results["silver"].output_rows == 3


def test_event_prefix_without_checkpoint_appends(spark, root):
    source = EventSource(landing(root), "csv", {"header": "true"}, streaming=False)
    flow = sales(root, source)
    for _ in range(2):
        run(spark, flow, ["bronze"])
    assert spark.read.parquet(flow.bronze_path).count() == 20


def test_query_sources(spark, root):
    spark.read.csv(landing(root), header=True).createOrReplaceTempView("sales_feed")
    flow = sales(root, CatalogSource("SELECT * FROM sales_feed"))
    assert run(spark, flow)["silver"].output_rows == 3
    step = CatalogSource("SELECT * FROM sales_feed", "sales_feed",
                         IncrementSpec("transaction_date"))
    flow = sales(f"{root}/step", step)
    assert run(spark, flow)["silver"].output_rows == 3
    assert run(spark, flow)["bronze"].output_rows == 0


def test_gold_layout(spark, root):
    flow = sales_flow(root).override(gold_sink=SinkSpec(
        mode="WRITE_TRUNCATE", partition_by=("date",), cluster_by=("product_id", "region")))
    assert all(r.success for r in run(spark, flow).values())
    assert {p.name for p in Path(flow.gold_path("daily_trend")).glob("date=*")} == {
        "date=2024-01-01", "date=2024-01-02", "date=2024-01-04"}
    assert gold(spark, flow, "revenue_by_product").count() == 3


def test_gold_as_catalog_tables(spark, root):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold_test")
    flow = sales_flow(root).override(gold_sink=SinkSpec(table="gold_test"))
    results = run(spark, flow)
    assert results["gold"].success and results["gold"].output_path == "gold_test"
    assert spark.table("gold_test.revenue_by_region").count() == 2
    spark.sql("DROP DATABASE gold_test CASCADE")


# ---------------------------------------------------------------- command line


def test_layer_choice():
    assert chosen_layers(parse([])) == ["bronze", "silver", "gold"]
    assert chosen_layers(parse(["--gold", "--silver"])) == ["silver"]
    both = parse(["--gold", "--layer", "bronze", "--layer", "silver"])
    assert chosen_layers(both) == ["bronze", "silver"]
    assert set(DOMAINS) == {"sales", "iot", "fintech", "web_logs"}


def test_command_line_with_a_config(spark, root):
    config = {
        "business_domain": "Sales", "bronze_table_name": "b", "silver_table_name": "s",
        "gold_table_name": "g",
        "source": {"type": "file", "format": "csv", "path": landing(root),
                   "options": {"header": "true", "inferSchema": "true"}},
        "cleaning_rules": {
            "null_drop_columns": ["product_id"],
            "data_type_fixes": {"amount": "try_cast(amount AS DOUBLE)"},
            "validation_rules": [{"column": "amount", "rule": "amount > 0"}],
        },
        "aggregations": {"n": {"type": "agg", "expression": "count(*)", "alias": "n"}},
    }
    Path(root, "flow.json").write_text(json.dumps(config))
    assert main(["--config", f"{root}/flow.json", "--root", root]) == 0
    assert rows(spark.read.parquet(f"{root}/gold/g/n")) == [(7,)]


def test_command_line(spark, root, capsys):
    assert main(["--root", root, "--input", landing(root), "--layer", "bronze",
                 "--layer", "silver"]) == 0
    assert "silver" in capsys.readouterr().out
    assert main(["--root", root, "--input", f"{root}/none", "--bronze"]) == 1
