"""Small append-only tables keep a bounded number of files."""

from pathlib import Path

import pytest
from helpers import rows

from trilode.sinks import log
from trilode.sinks.log import append_log, compact_log, read_log
from trilode.sources.control import last_mark, newest_mark, write_mark


def files(path):
    return sorted(p.name for p in Path(path).glob("*.parquet"))


def test_a_thousand_runs(spark, root):
    history = spark.range(1000).selectExpr("CAST(id AS string) run_id", "id AS n")
    history.repartition(150).write.parquet(f"{root}/log")
    assert len(files(f"{root}/log")) > 100
    append_log(spark.range(1).selectExpr("'new' run_id", "id AS n"), f"{root}/log")
    assert len(files(f"{root}/log")) == 1
    assert read_log(spark, f"{root}/log").count() == 1001
    assert [p.name for p in Path(root).iterdir()] == ["log"]


def test_files_stay_bounded(spark, root):
    for i in range(12):
        append_log(spark.createDataFrame([(i,)], "n int"), f"{root}/log", most=4)
        assert len(files(f"{root}/log")) <= 5
    assert sorted(r[0] for r in rows(read_log(spark, f"{root}/log"))) == list(range(12))


def test_few_files_are_left_alone(spark, root):
    append_log(spark.range(3).toDF("n"), f"{root}/log")
    before = files(f"{root}/log")
    assert compact_log(spark, f"{root}/log", spark.read.parquet(f"{root}/log").schema) == 0
    assert files(f"{root}/log") == before


def test_large_files_are_not_written_again(spark, root, monkeypatch):
    spark.range(100_000).toDF("n").coalesce(1).write.parquet(f"{root}/log")
    large = files(f"{root}/log")
    monkeypatch.setattr(log, "small_files", lambda s, p, below=50_000: small(s, p, below))
    for i in range(4):
        append_log(spark.range(1).toDF("n"), f"{root}/log", most=2)
    assert set(large) <= set(files(f"{root}/log"))
    assert spark.read.parquet(f"{root}/log").where("n < 1").count() >= 2


small = log.small_files


def test_death_before_the_old_files_go(spark, root, monkeypatch):
    """Both forms lie there for a while; no row is lost, and copies are dropped."""
    for i in range(3):
        spark.createDataFrame([(i,)], "n int").coalesce(1).write.mode("append").parquet(f"{root}/log")
    kept = {name: Path(root, "log", name).read_bytes() for name in files(f"{root}/log")}
    schema = spark.read.parquet(f"{root}/log").schema
    assert compact_log(spark, f"{root}/log", schema, most=1) == len(kept)
    for name, data in kept.items():
        Path(root, "log", name).write_bytes(data)
    assert sorted(r[0] for r in rows(read_log(spark, f"{root}/log"))) == [0, 1, 2]
    compact_log(spark, f"{root}/log", schema, most=1)
    assert sorted(r[0] for r in rows(spark.read.parquet(f"{root}/log"))) == [0, 1, 2]


def test_a_failed_compaction_loses_nothing(spark, root, monkeypatch):
    for i in range(3):
        spark.createDataFrame([(i,)], "n int").write.mode("append").parquet(f"{root}/log")
    schema = spark.read.parquet(f"{root}/log").schema
    before = files(f"{root}/log")
    with monkeypatch.context() as patch:
        patch.setattr("pyspark.sql.DataFrameWriter.parquet", broken)
        with pytest.raises(RuntimeError):
            compact_log(spark, f"{root}/log", schema, most=1)
    assert files(f"{root}/log") == before


def broken(*args, **options):
    raise RuntimeError("no space left")


def test_marks_survive_compaction(spark, root):
    path = f"{root}/marks"
    for i in range(5):
        write_mark(spark, path, "a", "day", f"2024-01-0{i + 1}", load_number=i, rows=i)
        write_mark(spark, path, "b", "day", f"2023-01-0{i + 1}", load_number=i, rows=i)
    schema = spark.read.parquet(path).schema
    before = newest_mark(spark, path, "a", "day")
    assert compact_log(spark, path, schema, most=2) > 9 and len(files(path)) == 1
    assert newest_mark(spark, path, "a", "day") == before
    assert last_mark(spark, path, "b", "day") == "2023-01-05"
