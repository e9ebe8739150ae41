from pathlib import Path

import pytest
from helpers import rows, unordered

from trilode.sinks.write import remove
from trilode.spec import EventSource
from trilode.streaming import ingest_stream, landing_stream, load_arrivals, read_arrivals

DDL = "n int, s string"


def drop(root, name, text):
    landing = Path(root, "landing")
    landing.mkdir(exist_ok=True)
    (landing / name).write_text(text)


def source(root, **more):
    return EventSource(f"{root}/landing", "csv", {"header": "true"}, schema=DDL, suffix=".csv",
                       track_file=True, **more)


def load(spark, root, **more):
    return load_arrivals(spark, source(root, **more), f"{root}/bronze", f"{root}/checkpoint")


def test_each_file_goes_in_once(spark, root):
    drop(root, "a.csv", "n,s\n1,x\n2,y\n")
    drop(root, "skip.txt", "n,s\n7,z\n")
    assert load(spark, root) == 2
    assert load(spark, root) == 0
    drop(root, "b.csv", "n,s\n3,z\n")
    assert load(spark, root) == 1
    bronze = spark.read.parquet(f"{root}/bronze")
    assert unordered(bronze.select("n", "s")) == [(1, "x"), (2, "y"), (3, "z")]
    assert bronze.filter("ingestion_timestamp IS NULL").isEmpty()
    names = {Path(r[0]).name for r in rows(bronze.select("source_file"))}
    assert names == {"a.csv", "b.csv"}


def test_empty_landing_makes_an_empty_bronze(spark, root):
    Path(root, "landing").mkdir()
    assert load(spark, root) == 0
    bronze = read_arrivals(spark, source(root), f"{root}/bronze")
    assert bronze.columns == ["n", "s", "ingestion_timestamp", "source_file"]
    assert bronze.count() == 0
    drop(root, "a.csv", "n,s\n1,x\n")
    assert load(spark, root) == 1


def test_malformed_values_become_null(spark, root):
    drop(root, "a.csv", "n,s\nbad,x\n")
    assert load(spark, root) == 1
    assert rows(spark.read.parquet(f"{root}/bronze").select("n", "s")) == [(None, "x")]


def test_files_per_batch_are_capped(spark, root):
    for i in range(6):
        drop(root, f"f{i}.csv", f"n,s\n{i},x\n")
    capped = source(root, max_files_per_trigger=2)
    query = ingest_stream(spark, capped, f"{root}/bronze", f"{root}/checkpoint")
    query.awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 6
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3


def names(folder, pattern="*.csv"):
    return sorted(p.name for p in Path(folder).rglob(pattern))


def test_committed_files_are_archived(spark, root):
    archive = f"{root}/processed"
    for name in "abc":
        drop(root, f"{name}.csv", f"n,s\n{ord(name)},x\n")
        assert load(spark, root, archive_dir=archive) == 1
        assert names(f"{root}/landing") == []
    assert names(archive) == ["a.csv", "b.csv", "c.csv"]
    assert spark.read.parquet(f"{root}/bronze").count() == 3


def test_archive_makes_good_for_a_run_that_died(spark, root, monkeypatch):
    archive = f"{root}/processed"
    drop(root, "a.csv", "n,s\n1,x\n")
    with monkeypatch.context() as broken:
        broken.setattr("trilode.streaming.ingest.move_files", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load(spark, root, archive_dir=archive)
    assert names(f"{root}/landing") == ["a.csv"]
    assert load(spark, root, archive_dir=archive) == 0
    assert names(archive) == ["a.csv"] and names(f"{root}/landing") == []


def test_files_of_one_name_do_not_overwrite_each_other(spark, root):
    Path(root, "processed").mkdir()
    Path(root, "processed", "a b.csv").write_text("old")
    drop(root, "a b.csv", "n,s\n1,x\n")
    load(spark, root, archive_dir=f"{root}/processed")
    assert names(f"{root}/processed", "*.csv*") == ["a b.csv", "a b.csv.batch-0"]


# ---------------------------------------------------------------- a lost checkpoint


def reset(spark, root, after_reset, second):
    drop(root, "a.csv", "n,s\n1,x\n2,y\n3,z\n")
    load(spark, root)
    remove(spark, f"{root}/checkpoint")
    if second:
        drop(root, "b.csv", second)
    return load(spark, root, after_reset=after_reset)


def numbers(spark, root):
    return [n for n, in unordered(read_arrivals(spark, source(root), f"{root}/bronze").select("n"))]


def test_another_checkpoint_is_refused(spark, root):
    with pytest.raises(ValueError, match="another checkpoint"):
        reset(spark, root, "refuse", "n,s\n4,x\n")
    assert numbers(spark, root) == [1, 2, 3]


def test_another_checkpoint_adds_when_asked(spark, root):
    assert reset(spark, root, "new_files", "n,s\n4,x\n5,x\n") == 2
    assert numbers(spark, root) == [1, 2, 3, 4, 5]
    drop(root, "c.csv", "n,s\n6,x\n")
    assert load(spark, root, after_reset="new_files") == 1
    assert load(spark, root, after_reset="add") == 0


def test_all_of_the_landing_again_when_asked(spark, root):
    assert reset(spark, root, "add", None) == 3
    assert numbers(spark, root) == [1, 1, 2, 2, 3, 3]


def test_a_checkpoint_without_its_offsets_is_refused(spark, root):
    drop(root, "a.csv", "n,s\n1,x\n")
    load(spark, root)
    remove(spark, f"{root}/checkpoint/offsets")
    with pytest.raises(ValueError, match="lost its offsets"):
        load(spark, root, after_reset="add")


def test_reset_words():
    with pytest.raises(ValueError, match="unknown after_reset"):
        EventSource("x", schema="a int", after_reset="hope")
    with pytest.raises(ValueError, match="needs track_file"):
        EventSource("x", schema="a int", after_reset="new_files")


def test_continuous_form(spark, root):
    drop(root, "a.csv", "n,s\n1,x\n")
    query = ingest_stream(spark, source(root), f"{root}/bronze", f"{root}/checkpoint", "1 second")
    try:
        query.processAllAvailable()
        drop(root, "b.csv", "n,s\n2,x\n")
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.read.parquet(f"{root}/bronze").count() == 2


def test_landing_stream_is_lazy(spark, root):
    Path(root, "landing").mkdir()
    assert landing_stream(spark, source(root)).isStreaming
