from datetime import date, datetime

import pytest
from helpers import plan, rows, unordered
from pyspark.sql import functions as F

from trilode import functions as T
from trilode.functions import sort_columns
from trilode.operators import (
    build_gold,
    fused_groups,
    group_table,
    metric_table,
    metrics,
    rows_of,
    top_n,
)
from trilode.plans.gold import fusable
from trilode.spec import AggSpec, FileSource, FlowSpec, GroupSpec, MetricSpec


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(
        [
            ("a", "n", 10.0, "COMPLETED", datetime(2024, 1, 1, 10)),
            ("a", "s", 5.0, "FAILED", datetime(2024, 1, 1, 11)),
            ("b", "n", None, "COMPLETED", datetime(2024, 1, 2, 11)),
            (None, None, 1.0, None, None),
        ],
        "product string, region string, amount double, status string, at timestamp",
    )


SUM = AggSpec("amount", "sum", "revenue")


def test_metrics_are_one_row_named_by_table(sales):
    row = metrics(sales, [MetricSpec("m1", "sum(amount)", "total"),
                          MetricSpec("m2", "avg(amount)", "total")])
    assert row.columns == ["m1", "m2"]
    assert rows(row) == [(16.0, 16.0 / 3)]


def test_metrics_over_nothing_stay_typed(sales):
    none = sales.limit(0)
    row = metrics(none, [
        MetricSpec("s", "sum(amount)", "s"), MetricSpec("n", "count(*)", "n"),
        MetricSpec("c", T.count_when("status = 'COMPLETED'"), "c"),
        MetricSpec("r", T.ratio(T.count_when("status = 'COMPLETED'"), F.count(F.lit(1))), "r"),
    ])
    assert rows(row) == [(None, 0, None, None)]
    assert row.dtypes == [("s", "double"), ("n", "bigint"), ("c", "bigint"), ("r", "double")]


def test_conditional_aggregates_keep_the_zeros(sales):
    done = "status = 'COMPLETED'"
    row = sales.agg(T.sum_when(done, "amount"), T.avg_when(done, "amount"), T.count_when(done),
                    T.ratio(T.count_when(done), F.count(F.lit(1))))
    # amounts: 10, 0, NULL, 0
    assert rows(row) == [(10.0, 10.0 / 3, 2, 0.5)]


def test_group_and_sort(sales):
    out = group_table(sales, GroupSpec("g", [SUM], ["product"], sort=["revenue DESC"]))
    assert rows(out) == [("a", 15.0), (None, 1.0), ("b", None)]
    up = group_table(sales, GroupSpec("g", [SUM], ["product"], sort=["revenue"]))
    assert rows(up) == [("b", None), (None, 1.0), ("a", 15.0)]


def test_count_column_and_count_rows(sales):
    group = GroupSpec("g", [AggSpec("amount", "count", "n"), AggSpec("*", "count", "all")],
                      ["region"])
    assert unordered(group_table(sales, group)) == [("n", 1, 2), ("s", 1, 1), (None, 1, 1)]


def test_trend_ignores_its_group_by(sales):
    group = GroupSpec("g", [SUM], ["product"], date_column="at", sort=["date ASC"])
    out = group_table(sales, group)
    assert out.columns == ["date", "revenue"]
    assert rows(out) == [(None, 1.0), (date(2024, 1, 1), 15.0), (date(2024, 1, 2), None)]


def test_hourly_trend(sales):
    group = GroupSpec("g", [SUM], date_column="at", grain="hour", sort=["hour"])
    out = rows(group_table(sales, group))
    assert out[1:] == [(datetime(2024, 1, 1, 10), 10.0), (datetime(2024, 1, 1, 11), 5.0),
                       (datetime(2024, 1, 2, 11), None)]


@pytest.mark.parametrize("name, want", [("min", 1.0), ("max", 10.0), ("mean", 16 / 3)])
def test_aggregate_name_is_free(sales, name, want):
    group = GroupSpec("g", [AggSpec("amount", name, "v")], ["one"])
    assert rows(group_table(sales.withColumn("one", F.lit(1)), group)) == [(1, want)]


@pytest.mark.parametrize("name", ["collect_list", "PERCENTILE", "sum(x)--", ""])
def test_unfit_aggregate_names(name):
    with pytest.raises(ValueError):
        AggSpec("amount", name, "v")


def test_specs_check_themselves():
    with pytest.raises(ValueError):
        GroupSpec("g", [], ["k"])
    with pytest.raises(ValueError):
        GroupSpec("g", [SUM])
    with pytest.raises(ValueError):
        GroupSpec("g", [SUM], ["k"], grain="week")
    with pytest.raises(ValueError):
        FlowSpec("d", "r", "b", "s", "g", FileSource("p"),
                 outputs=[MetricSpec("m", "1", "a"), MetricSpec("m", "1", "b")])


def test_sort_items():
    assert len(sort_columns(["a", "b desc", "'c' ASC"])) == 3
    for bad in ("a DOWN", "a DESC NULLS"):
        with pytest.raises(ValueError):
            sort_columns([bad])


def test_top_n_is_one_operator(sales):
    top = top_n(sales.select("product", "amount"), ["amount DESC"], 2)
    assert rows(top) == [("a", 10.0), ("a", 5.0)]
    assert "TakeOrderedAndProject" in plan(top)


GROUPS = (
    GroupSpec("by_product", [SUM], ["product"], sort=["revenue DESC"]),
    GroupSpec("low", [AggSpec("amount", "min", "least")], ["product"]),
    GroupSpec("by_both", [SUM, AggSpec("*", "count", "n")], ["region", "product"]),
    GroupSpec("daily", [SUM], date_column="at", sort=["date ASC"]),
    GroupSpec("hourly", [SUM], date_column="at", grain="hour"),
)


def test_fused_equals_separate(sales):
    fused = fused_groups(sales, GROUPS)
    for group in GROUPS:
        mine, alone = rows_of(fused, GROUPS, group), group_table(sales, group)
        assert mine.columns == alone.columns
        assert mine.dtypes == alone.dtypes
        assert unordered(mine) == unordered(alone)
        if group.sort:
            assert rows(mine) == rows(alone)


def test_fused_over_nothing(sales):
    fused = fused_groups(sales.limit(0), GROUPS)
    assert all(rows(rows_of(fused, GROUPS, g)) == [] for g in GROUPS)


def test_fused_reads_the_input_once(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    amount = [AggSpec("l_extendedprice", "sum", "revenue")]
    groups = [GroupSpec("p", amount, ["l_partkey"]), GroupSpec("f", amount, ["l_returnflag"]),
              GroupSpec("d", amount, date_column="l_shipdate")]
    text = plan(fused_groups(lineitem, groups), "simple")
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_returnflag:string," \
        "l_shipdate" in text


def test_when_fusing_is_possible():
    assert fusable(GROUPS)
    assert not fusable(GROUPS[:1])
    on_derived = GroupSpec("x", [AggSpec("date", "max", "last")], date_column="at")
    assert not fusable([*GROUPS, on_derived])


def test_build_gold_keeps_the_declared_order(sales):
    flow = FlowSpec("d", "r", "b", "s", "g", FileSource("p"),
                    outputs=[GROUPS[0], MetricSpec("m", "sum(amount)", "total"), GROUPS[3]])
    tables = build_gold(sales, flow)
    assert list(tables) == ["by_product", "m", "daily"]
    assert rows(tables["m"]) == [(16.0,)]
    assert rows(metric_table(sales, flow.metrics[0])) == [(16.0,)]
