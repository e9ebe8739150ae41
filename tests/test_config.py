import pytest
from pyspark.sql import types as T

from trilode import flow_from_config
from trilode.plans.config import schema_ddl
from trilode.plans.domains import FINTECH_OUTPUTS, SALES_CLEANING, SALES_OUTPUTS
from trilode.spec import DatabaseSource, EventSource, FileSource, GroupSpec, MetricSpec

CONFIG = {
    "business_domain": "Library Loans",
    "bronze_table_name": "loans_raw",
    "silver_table_name": "loans_clean",
    "gold_table_name": "loans_gold",
    "gold_output_format": "parquet",
    "source": {
        "type": "file", "environment": "offline", "format": "csv", "path": "data/raw/",
        "options": {"header": "true"},
        "s3_bucket": "landing", "s3_prefix": "drop/loans/", "s3_suffix": ".txt",
        "gcs_bucket": "g-landing", "gcs_prefix": "in/", "gcs_suffix": ".txt",
        "database": {
            "connection": {"url": "jdbc:x", "user": "u", "password": "p", "driver": "d"},
            "query": "SELECT branch, fee FROM loans WHERE open",
            "incremental": {"enabled": True, "column": "lent_at",
                            "last_value_table": "marks"},
            "batch_size": 123,
        },
    },
    "gcp": {"warehouse": {
        "project": "p", "dataset": "d", "partitioning": {"enabled": True, "field": "date",
                                                         "type": "DAY"},
        "clustering": ["branch", "shelf"], "write_disposition": "WRITE_TRUNCATE"}},
    "schema_info": """
        lent_on: date
        fee: decimal(9,3)
        state: string (OUT, BACK)
        days: integer
    """,
    "available_columns": ["fee"],
    "cleaning_rules": {
        "null_drop_columns": ["branch"],
        "null_fill_columns": {"fee": "0"},
        "deduplication_columns": ["branch", "fee"],
        "deduplication_order": ["lent_on"],
        "validation_rules": [{"column": "fee", "rule": "fee > 0"}],
        "data_type_fixes": {"fee": "try_cast(fee AS DOUBLE)"},
    },
    "aggregations": {
        "total": {"type": "agg", "expression": "sum(fee)", "alias": "total"},
        "daily": {"type": "group_by", "group_by": ["lent_on"],
                  "date_column": "lent_on",
                  "aggregations": [{"column": "fee", "function": "sum", "alias": "v"}],
                  "sort": ["date ASC"]},
    },
}


def with_source(**changes):
    return flow_from_config(CONFIG, {"source": {**CONFIG["source"], **changes}})


def test_file_source():
    flow = flow_from_config(CONFIG)
    assert flow.source == FileSource(
        "data/raw/", "csv", {"header": "true"}, schema=schema_ddl(CONFIG["schema_info"]))
    assert flow.bronze_path == "data/bronze/loans_raw/"
    assert flow.gold_path("total") == "data/gold/loans_gold/total"
    assert flow.columns == ("fee",)
    assert [type(o) for o in flow.outputs] == [MetricSpec, GroupSpec]
    assert flow.groups[0].keys == ("date",)
    assert flow.cleaning.rules[0].description == ""


def test_declared_schema_for_files():
    assert flow_from_config(CONFIG, declare_schema=False).source.schema is None
    declared = flow_from_config(CONFIG).source.schema
    assert declared.startswith("`lent_on` date, `fee` decimal(9,3)")


def test_overrides_are_shallow():
    flow = flow_from_config(CONFIG, {"source": {"type": "file", "path": "x"}}, root="/r")
    assert flow.source.path == "x" and flow.source.options["inferSchema"] == "true"
    assert flow.bronze_path == "/r/bronze/loans_raw/"
    assert flow.override(domain="Other").domain == "Other"


@pytest.mark.parametrize("env, path, root", [
    ("aws", "s3://landing/drop/loans/", "s3://landing"),
    ("gcp", "gs://g-landing/in/", "gs://g-landing"),
])
def test_event_source(env, path, root):
    flow = with_source(type="event", environment=env)
    assert isinstance(flow.source, EventSource) and flow.source.streaming
    assert (flow.source.path, flow.source.suffix, flow.source.track_file) == (path, ".txt", True)
    assert flow.root == root
    offline = with_source(type="event", environment="offline")
    assert not offline.source.track_file and offline.source.path == "data/raw/"


def test_database_source():
    source = with_source(type="database").source
    assert isinstance(source, DatabaseSource)
    assert (source.url, source.fetch_size, source.increment.control_table) == (
        "jdbc:x", 123, "marks")


def test_every_scale_option_can_be_set():
    database = CONFIG["source"]["database"] | {
        "partition_column": "id", "num_partitions": 8, "lower_bound": 0, "upper_bound": 100}
    source = with_source(type="database", database=database).source
    assert (source.name, source.partition_column, source.num_partitions) == ("loans_raw", "id", 8)
    assert (source.lower_bound, source.upper_bound) == ("0", "100")
    event = with_source(type="event", max_files_per_trigger=5, archive_dir="done").source
    assert (event.max_files_per_trigger, event.archive_dir, event.streaming) == (5, "done", True)
    assert not with_source(type="event", mode="prefix").source.streaming
    flow = flow_from_config(CONFIG, {"fuse": False})
    assert not flow.fuse and flow.cleaning.dedup_order == ("lent_on",)
    sink = flow.gold_sink
    assert (sink.format, sink.partition_by, sink.cluster_by) == ("parquet", ("date",), ("branch", "shelf"))


def test_flat_source_keys():
    config = {k: v for k, v in CONFIG.items() if k != "source"}
    config |= {"source_format": "json", "source_path": "data/raw/s/",
               "source_options": {"multiLine": "true"}}
    assert flow_from_config(config, declare_schema=False).source == FileSource(
        "data/raw/s/", "json", {"multiLine": "true"})


def test_warehouse_sink():
    sink = flow_from_config(CONFIG, {"gold_output_format": "bigquery"}).gold_sink
    assert (sink.format, sink.table, sink.mode) == ("bigquery", "p.d", "WRITE_TRUNCATE")
    assert sink.partition_by == ("date",) and sink.cluster_by == ("branch", "shelf")


@pytest.mark.parametrize("changes", [
    {"source": {"type": "carrier pigeon"}},
    {"source": {"type": "file", "environment": "moon"}},
    {"source": {"type": "event", "environment": "aws", "s3_bucket": "b"}},
    {"source": {"type": "database", "database": {"query": "q"}}},
    {"aggregations": {"x": {"type": "cube"}}},
    {"source": {"type": "file", "environment": "aws"}},
    {"source": {"type": "database", "environment": "gcp", "database": {"query": "q"}}},
    {"source": {"type": "event", "mode": "sometimes"}},
    {"source": {"type": "event"}, "schema_info": None},
    {"source": {"type": "file", "paht": "x"}},
    {"gold_output_format": "delta"},
    {"cleaning_rules": {"dedup": ["a"]}},
    {"aggregations": {"x": {"type": "agg", "expression": "col('a').foo()", "alias": "a"}}},
])
def test_bad_blocks(changes):
    with pytest.raises(ValueError):
        flow_from_config(CONFIG, changes)


def test_missing_fields():
    with pytest.raises(ValueError, match="cleaning_rules"):
        flow_from_config({k: v for k, v in CONFIG.items() if k != "cleaning_rules"})


def test_schema_text(spark):
    assert T.StructType.fromDDL(schema_ddl(CONFIG["schema_info"])) == T.StructType([
        T.StructField("lent_on", T.DateType()),
        T.StructField("fee", T.DecimalType(9, 3)),
        T.StructField("state", T.StringType()),
        T.StructField("days", T.IntegerType()),
    ])
    with pytest.raises(ValueError):
        schema_ddl("nothing here")


def test_ready_made_flows_have_unique_outputs():
    assert len({o.name for o in SALES_OUTPUTS}) == 5
    assert len({o.name for o in FINTECH_OUTPUTS}) == 7
    assert SALES_CLEANING.dedup_keys == (
        "transaction_date", "product_id", "customer_email", "amount")
