"""Quarantine in one pass, and Silver and Gold by increment."""

import json
from pathlib import Path

import pytest
from helpers import plan, unordered
from pyspark.sql import functions as F

from trilode.operators import clean, clean_split, failure_bits, judge, repeated_keys, silver_contract
from trilode.plans import increment, run
from trilode.plans.increment import read_gold, run_increment
from trilode.spec import (
    AggSpec,
    CatalogSource,
    CleaningSpec,
    EventSource,
    FileSource,
    FlowSpec,
    GroupSpec,
    IncrementSpec,
    MetricSpec,
    RuleSpec,
)

SPEC = CleaningSpec(
    type_fixes={"v": "try_cast(v AS INT)"}, null_drop=["k"], null_fill={"v": "0"},
    rules=[RuleSpec("v", "100 / v > 0", "not negative"), RuleSpec("s", "s IN ('a', 'b')")],
    dedup_keys=["k"], dedup_order=["v DESC"])
ROWS = [("1", 1, "a"), ("2", 1, "b"), ("-3", 1, "c"), ("-3", 1, "c"), (None, 2, "a"), ("x", 2, None),
        ("5", None, "z"), ("7", 3, None), ("7", 4, "a")]


def feed(spark):
    return spark.createDataFrame(ROWS, "v string, k int, s string")


def test_every_row_is_kept_a_copy_or_set_aside(spark):
    spec = CleaningSpec(**{**SPEC.__dict__, "rules": [RuleSpec("v", "v > 0", "positive"), SPEC.rules[1]]})
    split = clean_split(feed(spark), spec)
    kept = split.where("failed_rules = 0").drop("failed_rules")
    assert unordered(kept) == unordered(clean(feed(spark), spec)) == [(2, 1, "b"), (7, 4, "a")]
    assert failure_bits(spec) == ["positive", "s", "no k"]
    assert unordered(split.where("failed_rules <> 0").select("v", "k", "failed_rules")) == sorted([
        (-3, 1, 3), (-3, 1, 3), (0, 2, 1), (0, 2, 3), (5, None, 4), (7, 3, 2)], key=repr)


def test_rules_are_not_asked_about_rows_that_miss_a_column(spark):
    df = spark.createDataFrame([(0, None), (5, 1)], "a int, b int")
    spec = CleaningSpec(null_drop=["b"], rules=[RuleSpec("a", "10 / a > 1")])  # fails on 0 under ANSI
    assert unordered(judge(df, spec).select("a", "failed_rules")) == [(0, 2), (5, 0)]


def test_too_many_rules_for_the_mask(spark):
    with pytest.raises(ValueError, match="at most 62"):
        judge(spark.range(1), CleaningSpec(rules=[RuleSpec("id", "id = 0")] * 63))


def test_one_scan_and_no_shuffle_of_rejects_by_key(spark, root):
    feed(spark).write.parquet(f"{root}/in")
    text = plan(clean_split(spark.read.parquet(f"{root}/in"), SPEC), "simple")
    assert text.count("FileScan") == 1


def flow(root, source=None, **more):
    return FlowSpec("d", f"{root}/lake", "raw", "clean", "gold",
                    source or FileSource(f"{root}/in", "parquet"), **more)


def test_quarantine_run(spark, root):
    feed(spark).where("v <> 'x' OR v IS NULL").write.parquet(f"{root}/in")
    spec = CleaningSpec(**{**SPEC.__dict__, "rules": [RuleSpec("v", "v > 0", "positive"), SPEC.rules[1]]})
    mine = flow(root, cleaning=spec, quarantine=True)
    result = run(spark, mine, ["bronze", "silver"], checks=True, strict=True)
    assert result["silver"].success and result["silver"].output_rows == 2
    silver, aside = (spark.read.parquet(p) for p in (mine.silver_path, mine.quarantine_path))
    assert (silver.count(), aside.count()) == (2, 5)
    report = unordered(spark.read.parquet(mine.rules_path).select("position", "failed", "total"))
    assert report == [(1, 3, 7), (2, 3, 7)]
    # the report of a run without quarantine, which looks at Bronze again
    other = FlowSpec(**{**mine.__dict__, "root": f"{root}/other", "quarantine": False})
    run(spark, other, ["bronze", "silver"], checks=True)
    assert unordered(spark.read.parquet(other.rules_path).select("position", "failed", "total")) == report


def test_a_failed_run_leaves_the_old_tables(spark, root):
    feed(spark).write.parquet(f"{root}/in")
    mine = flow(root, quarantine=True, cleaning=CleaningSpec(rules=[RuleSpec("k", "k = 1")]))
    assert run(spark, mine, ["bronze", "silver"])["silver"].output_rows == 4
    broken = flow(root, quarantine=True, cleaning=CleaningSpec(
        rules=[RuleSpec("k", "assert_true(k < 4, 'stop') IS NULL")]))
    assert not run(spark, broken, ["silver"])["silver"].success
    assert spark.read.parquet(mine.silver_path).count() == 4
    assert spark.read.parquet(mine.quarantine_path).count() == 5
    assert not list(Path(root, "lake", "staging").rglob("*.parquet"))


def test_nothing_rejected_and_nothing_kept(spark, root):
    feed(spark).write.parquet(f"{root}/in")
    for rule, sizes in (("true", (9, 0)), ("false", (0, 9))):
        mine = flow(root, quarantine=True, cleaning=CleaningSpec(rules=[RuleSpec("k", rule)]))
        assert run(spark, mine, ["bronze", "silver"])["silver"].success
        assert (spark.read.parquet(mine.silver_path).count(),
                spark.read.parquet(mine.quarantine_path).count()) == sizes


def test_repeated_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (None, None), (None, None), (2, "b")],
                               "k int, s string")
    assert repeated_keys(df, ["k", "s"]).first()[0] == 2
    assert repeated_keys(df, ["k"]).first()[0] == 3
    assert repeated_keys(df.limit(0), ["k"]).first()[0] == 0
    upper = df.union(df.where("k = 2").select("k", F.upper("s"))).select(
        "k", F.expr("collate(s, 'UTF8_LCASE')").alias("s"))
    assert repeated_keys(upper, ["k", "s"]).first()[0] == 3 and repeated_keys(upper, ["s"]).first()[0] == 4
    text = plan(silver_contract(df, CleaningSpec(dedup_keys=["k", "s"])), "simple")
    by_key = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(by_key) == 1 and "__key_hash" in by_key[0] and " k#" not in by_key[0]


# ---------------------------------------------------------------- by increment


def drop(root, name, rows):
    Path(root, "landing").mkdir(exist_ok=True)
    Path(root, "landing", name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def stream(root, **more):
    source = EventSource(f"{root}/landing", "json", schema="k int, d date, v double")
    return flow(root, source, **more)


def row(k, v, day=1):
    return {"k": k, "d": f"2024-01-0{day}", "v": v}


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


OUTPUTS = [
    GroupSpec("daily", [AggSpec("v", "sum", "total"), AggSpec("v", "avg", "mean"), AggSpec("*", "count", "n"),
                        AggSpec("v", "min", "low")], date_column="d"),
    MetricSpec("top", "max(v * 2)", "top"), MetricSpec("rows", "count(*)", "rows"),
]


def step(spark, mine, **more):
    assert run(spark, mine, ["bronze"])["bronze"].success
    return run_increment(spark, mine, **more)


def test_untouched_buckets_keep_their_files(spark, root):
    mine = stream(root, cleaning=CleaningSpec(dedup_keys=["k"], dedup_order=["v DESC"]))
    drop(root, "a.json", [row(k, 1.0) for k in range(200)])
    first = step(spark, mine, buckets=8)
    assert (first.added, first.rewritten) == (200, ())
    before = files(mine.silver_path)
    drop(root, "b.json", [row(5, 9.0), row(6, 0.5), row(900, 1.0)])
    second = step(spark, mine, buckets=8)
    assert second.added == 2 and len(second.rewritten) == 1
    after = files(mine.silver_path)
    kept = {n for n in before if f"bucket={second.rewritten[0]}/" not in n}
    assert {n: after[n] for n in kept} == {n: before[n] for n in kept}
    got = spark.read.parquet(mine.silver_path)
    assert got.count() == 201 and got.where("k = 5").first().v == 9.0
    assert step(spark, mine).added == 0  # nothing has come


def test_increments_equal_a_rebuild(spark, root):
    mine = stream(root, cleaning=CleaningSpec(rules=[RuleSpec("v", "v > 0")], dedup_keys=["k"]),
                  outputs=OUTPUTS)
    for name, rows in (("a", [row(k, k, 1 + k % 3) for k in range(30)]),
                       ("b", [row(k, k, 1 + k % 3) for k in range(20, 50)] * 2),
                       ("c", [row(None, 4.0), row(None, 4.0), row(7, -1.0)])):
        drop(root, f"{name}.json", rows)
        step(spark, mine, buckets=4)
    whole = FlowSpec(**{**mine.__dict__, "silver_table": "again", "gold_table": "again"})
    run(spark, whole, ["silver", "gold"])
    columns = ["k", "d", "v"]
    assert unordered(spark.read.parquet(mine.silver_path).select(*columns)) == unordered(
        spark.read.parquet(whole.silver_path).select(*columns))
    for output in OUTPUTS:
        wanted = spark.read.parquet(whole.gold_path(output.name))
        assert unordered(read_gold(spark, mine, output.name)) == unordered(wanted)


@pytest.mark.parametrize("dies_at", ["_into_silver", "_partial", "remove"])
def test_a_step_that_died_is_finished(spark, root, monkeypatch, dies_at):
    mine = stream(root, cleaning=CleaningSpec(dedup_keys=["k"]), outputs=OUTPUTS)
    drop(root, "a.json", [row(k, 1.0) for k in range(10)])
    step(spark, mine)
    drop(root, "b.json", [row(k, 1.0) for k in range(5, 15)])
    with monkeypatch.context() as broken:
        real = getattr(increment, dies_at)

        def die(*a, **k):
            if dies_at == "_into_silver":
                real(*a, **k)  # the rows are in, the step does not know it
            raise OSError("lost")

        broken.setattr(increment, dies_at, die)
        with pytest.raises(OSError):
            step(spark, mine)
    drop(root, "c.json", [row(k, 1.0) for k in range(12, 17)])
    step(spark, mine)
    step(spark, mine)
    assert sorted(r.k for r in spark.read.parquet(mine.silver_path).collect()) == list(range(17))
    assert read_gold(spark, mine, "rows").first().rows == 17


def test_old_batches_are_not_read(spark, root):
    mine = stream(root, cleaning=CleaningSpec(dedup_keys=["k"]))
    drop(root, "a.json", [row(1, 1.0)])
    step(spark, mine)
    for old in Path(mine.bronze_path).rglob("batch_id=0/*.parquet"):
        old.write_bytes(b"not parquet any more")
    drop(root, "b.json", [row(2, 1.0)])
    assert step(spark, mine).added == 1


def test_without_keys_every_step_adds_its_rows(spark, root):
    mine = stream(root, outputs=OUTPUTS)
    for name in "ab":
        drop(root, f"{name}.json", [row(1, 1.0), row(1, 1.0)])
        step(spark, mine)
    assert spark.read.parquet(mine.silver_path).count() == 4
    assert read_gold(spark, mine, "rows").first().rows == 4


def test_database_increments(spark, root):
    source = CatalogSource("SELECT * FROM trilode_inc", increment=IncrementSpec("k"))
    mine = flow(root, source, cleaning=CleaningSpec(dedup_keys=["k"]), outputs=[OUTPUTS[2]])
    for upto in (5, 9):
        spark.range(upto).select(F.col("id").alias("k")).createOrReplaceTempView("trilode_inc")
        assert step(spark, mine).added == (5 if upto == 5 else 4)
    assert read_gold(spark, mine, "rows").first().rows == 9


def test_what_does_not_merge_is_refused(spark, root):
    keyed = CleaningSpec(dedup_keys=["k"], dedup_order=["v"])
    for mine, text in (
        (stream(root, outputs=[GroupSpec("g", [AggSpec("v", "stddev", "s")], ["k"])]), "stddev cannot"),
        (stream(root, outputs=[MetricSpec("m", "sum(v) / count(*)", "m")]), "'m' is not one"),
        (stream(root, outputs=[MetricSpec("m", "count(DISTINCT v)", "m")]), "'m' is not one"),
        (stream(root, outputs=[OUTPUTS[1]], cleaning=keyed), "leave out dedup_order"),
    ):
        with pytest.raises(ValueError, match=text):
            run_increment(spark, mine)
    with pytest.raises(ValueError, match="tells new rows"):
        run_increment(spark, flow(root))
