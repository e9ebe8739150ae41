"""Lines that do not fit a declared schema go to a table of their own."""

from pathlib import Path

import pytest
from helpers import unordered

from trilode.plans.run import read_bronze, read_rescued, run
from trilode.sources.files import RESCUED, rescued_report
from trilode.spec import EventSource, FileSource, FlowSpec

DDL = "id bigint, amount double, name string"
CSV = {"a.csv": "id,amount,name\n1,1.5,ann\n2,oops,bob\n3,2.5\n4,1,x,y\n5,,\n",
       "b.csv": "id,amount,name\nz,1,q\n6,3,w\n"}
JSON = {"a.json": '{"id": 1, "amount": 1.5, "name": "ann"}\n{"id": "x", "name": "bob"}\n{"id": 3\n'
                  '{"id": 4}\n'}


def flow_of(root, files, source=FileSource, **options):
    folder = Path(root, "landing")
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / name).write_text(text)
    kind = next(iter(files)).rpartition(".")[2]
    reader = {"header": "true"} if kind == "csv" else {}
    return FlowSpec("x", root, "raw", "clean", "totals",
                    source(str(folder), kind, reader, schema=DDL, rescue=True, **options))


def names(df):
    return {Path(r.source_file).name: r.rescued for r in df.collect()}


def test_csv_lines(spark, root):
    flow = flow_of(root, CSV)
    result = run(spark, flow, ["bronze"], checks=True, strict=True)["bronze"]
    assert (result.success, result.input_rows, result.output_rows) == (True, 7, 3)
    bronze = read_bronze(spark, flow)
    assert RESCUED not in bronze.columns
    assert unordered(bronze.select("id", "amount", "name")) == [
        (1, 1.5, "ann"), (5, None, None), (6, 3.0, "w")]
    rescued = read_rescued(spark, flow)
    assert unordered(rescued.select(RESCUED)) == [
        ("2,oops,bob",), ("3,2.5",), ("4,1,x,y",), ("z,1,q",)]
    assert names(rescued_report(rescued)) == {"a.csv": 3, "b.csv": 1}


def test_json_lines(spark, root):
    flow = flow_of(root, JSON)
    result = run(spark, flow, ["bronze"])["bronze"]
    assert (result.input_rows, result.output_rows) == (4, 2)
    assert unordered(read_bronze(spark, flow).select("id", "amount", "name")) == [
        (1, 1.5, "ann"), (4, None, None)]
    assert unordered(read_rescued(spark, flow).select(RESCUED)) == [
        ('{"id": "x", "name": "bob"}',), ('{"id": 3',)]


def test_a_run_replaces_both_tables(spark, root):
    run(spark, flow_of(root, CSV), ["bronze"])
    flow = flow_of(root, {"a.csv": "id,amount,name\n1,1,a\n", "b.csv": "id,amount,name\n"})
    assert run(spark, flow, ["bronze"])["bronze"].output_rows == 1
    assert read_rescued(spark, flow).count() == 0 and read_bronze(spark, flow).count() == 1


def test_whole_chain_without_the_text_column(spark, root):
    flow = flow_of(root, CSV)
    results = run(spark, flow)
    assert all(r.success for r in results.values())
    assert RESCUED not in spark.read.parquet(flow.silver_path).columns


def test_stream(spark, root):
    flow = flow_of(root, CSV, EventSource, archive_dir=f"{root}/archive", max_files_per_trigger=1)
    assert run(spark, flow, ["bronze"])["bronze"].output_rows == 3
    assert names(rescued_report(read_rescued(spark, flow))) == {"a.csv": 3, "b.csv": 1}
    Path(root, "landing", "c.csv").write_text("id,amount,name\n7,bad,n\n")
    Path(root, "landing", "d.csv").write_text("id,amount,name\n8,8,n\n")
    assert run(spark, flow, ["bronze"])["bronze"].output_rows == 1
    assert names(rescued_report(read_rescued(spark, flow))) == {"a.csv": 3, "b.csv": 1, "c.csv": 1}
    assert unordered(read_bronze(spark, flow).select("id")) == [(1,), (5,), (6,), (8,)]
    assert {p.name for p in Path(root, "archive").glob("*.csv")} == {
        "a.csv", "b.csv", "c.csv", "d.csv"}


def test_stream_without_misfits(spark, root):
    flow = flow_of(root, {"a.csv": "id,amount,name\n1,1,a\n"}, EventSource)
    assert run(spark, flow, ["bronze"])["bronze"].output_rows == 1
    assert read_rescued(spark, flow).count() == 0


@pytest.mark.parametrize("options", [{"format": "csv"}, {"format": "parquet", "schema": DDL}])
def test_needs_text_and_a_schema(options):
    with pytest.raises(ValueError, match="rescue"):
        FileSource("x", rescue=True, **options)


def test_appended_prefixes_are_refused():
    with pytest.raises(ValueError, match="rescue"):
        EventSource("x", "csv", schema=DDL, streaming=False, rescue=True)
