"""Gold outputs that change hands in one step, and overwrites that fail without loss."""

from dataclasses import replace
from pathlib import Path

import pytest
from helpers import rows, unordered

from trilode.plans import gold
from trilode.plans.gold import published_run, read_output, read_outputs, write_gold
from trilode.plans.run import run
from trilode.sinks.write import replaced_rows, swap_all, written_rows
from trilode.spec import AggSpec, FileSource, FlowSpec, GroupSpec, MetricSpec, SinkSpec


def flow_of(root, **options):
    return FlowSpec(
        "shop", root, "raw", "clean", "totals", FileSource(f"{root}/landing", "parquet"),
        outputs=[MetricSpec("total", "count(*)", "n"), MetricSpec("top", "max(id)", "top"),
                 GroupSpec("by_key", [AggSpec("*", "count", "n")], ["key"]),
                 GroupSpec("by_kind", [AggSpec("*", "count", "n")], ["kind"])],
        **options)


def sales(spark, n):
    return spark.range(n).selectExpr("id", "id % 3 AS key", "id % 2 AS kind")


def failing_writes(monkeypatch, name):
    def write(df, sink):
        if sink.path.rstrip("/").endswith(name):
            raise RuntimeError("no space left")
        return written_rows(df, sink)

    monkeypatch.setattr(gold, "written_rows", write)


def state(spark, flow):
    return {name: unordered(df) for name, df in read_outputs(spark, flow).items()}


@pytest.mark.parametrize("publish", [True, False])
@pytest.mark.parametrize("fuse", [True, False])
def test_failure_in_the_middle_leaves_all_old_outputs(spark, root, monkeypatch, publish, fuse):
    flow = flow_of(root, publish=publish, fuse=fuse)
    write_gold(sales(spark, 10), flow)
    old = state(spark, flow)
    with monkeypatch.context() as patch:
        failing_writes(patch, "by_kind")
        with pytest.raises(RuntimeError):
            write_gold(sales(spark, 20), flow)
    assert state(spark, flow) == old and old["total"] == [(10,)]
    assert write_gold(sales(spark, 20), flow) == {"total": 1, "top": 1, "by_key": 3, "by_kind": 2}
    assert state(spark, flow)["by_kind"] == [(0, 10), (1, 10)]
    assert not list(Path(root, "staging", "totals").parent.glob("totals/*"))


def test_runs_are_kept_for_readers_that_have_begun(spark, root):
    flow = flow_of(root, publish=True, keep_runs=2)
    begun = []
    for n in (3, 6, 9):
        write_gold(sales(spark, n), flow)
        begun.append(read_output(spark, flow, "total"))
    assert [rows(df) for df in begun[1:]] == [[(6,)], [(9,)]]
    folders = [p.name for p in Path(flow.gold_path("runs")).iterdir()]
    assert len(folders) == 2 and published_run(spark, flow) in folders


def test_folders_of_unpublished_runs_stay(spark, root):
    flow = flow_of(root, publish=True, keep_runs=1)
    write_gold(sales(spark, 3), flow)
    other = Path(flow.gold_path("runs"), "still-writing")
    other.mkdir()
    write_gold(sales(spark, 6), flow)
    assert other.exists() and len(list(other.parent.iterdir())) == 2


def test_nothing_published_is_an_error(spark, root):
    with pytest.raises(ValueError, match="published"):
        read_outputs(spark, flow_of(root, publish=True))


def test_two_flows_publish_apart(spark, root):
    one, two = flow_of(root, publish=True), replace(flow_of(root, publish=True), gold_table="other")
    write_gold(sales(spark, 3), one)
    write_gold(sales(spark, 6), two)
    assert rows(read_output(spark, one, "total")) == [(3,)]
    assert rows(read_output(spark, two, "total")) == [(6,)]


@pytest.mark.parametrize("sink", [SinkSpec(table="db.t"), SinkSpec(format="csv"),
                                  SinkSpec(mode="append")])
def test_publish_needs_parquet_files_that_are_overwritten(root, sink):
    with pytest.raises(ValueError, match="publish"):
        flow_of(root, publish=True, gold_sink=sink)


def test_contract_of_published_outputs(spark, root):
    flow = flow_of(root, publish=True)
    sales(spark, 10).write.parquet(flow.source.path)
    results = run(spark, flow, checks=True, strict=True)
    assert results["gold"].success
    checks = spark.read.parquet(flow.checks_path).where("layer = 'gold'")
    assert checks.count() == 4 and checks.where("passed").count() == 4


def test_layout_columns_and_stale_outputs_stay(spark, root):
    flow = flow_of(root, gold_sink=SinkSpec(partition_by=["key"]))
    Path(flow.gold_path("older")).mkdir(parents=True)
    write_gold(sales(spark, 9), flow)
    assert {p.name for p in Path(flow.gold_path("by_key")).glob("key=*")} == {
        "key=0", "key=1", "key=2"}
    assert Path(flow.gold_path("older")).exists()


def test_swap_puts_everything_back_on_failure(spark, root):
    for name in ("a", "b", "new_a"):
        spark.createDataFrame([(name,)], "x string").write.parquet(f"{root}/{name}")
    with pytest.raises(OSError):
        swap_all(spark, [(f"{root}/new_a", f"{root}/a"), (f"{root}/missing", f"{root}/b")])
    assert [rows(spark.read.parquet(f"{root}/{n}"))[0][0] for n in ("a", "b", "new_a")] == [
        "a", "b", "new_a"]
    assert {p.name for p in Path(root).iterdir()} == {"a", "b", "new_a"}
    swap_all(spark, [(f"{root}/new_a", f"{root}/a")])
    assert rows(spark.read.parquet(f"{root}/a")) == [("new_a",)]
    assert {p.name for p in Path(root).iterdir()} == {"a", "b"}


def test_failed_overwrite_keeps_the_old_table(spark, root):
    sink = SinkSpec(f"{root}/t")
    assert replaced_rows(spark.range(5), sink, f"{root}/staging/x") == 5
    with pytest.raises(Exception, match="broken"):
        replaced_rows(spark.range(9).selectExpr("raise_error('broken')"), sink, f"{root}/staging/x")
    assert spark.read.parquet(f"{root}/t").count() == 5
    assert not Path(root, "staging", "x").exists()
