from dataclasses import replace
from datetime import datetime

import pytest
from helpers import plan, rows, unordered
from pyspark.sql import functions as F

from trilode.sources import (
    ensure_table,
    inline_rows,
    last_mark,
    late_rows,
    load_increment,
    plan_increment,
    read_files,
    read_increments,
    read_query,
    sales_rows,
    sales_sample,
    with_lineage,
    write_mark,
)
from trilode.sources.control import mark_text
from trilode.sources.queries import (
    _bound,
    as_relation,
    jdbc_options,
    partition_options,
    rank_query,
    split_predicates,
    split_window,
    unmarked_rows,
)
from trilode.spec import CatalogSource, DatabaseSource, EventSource, FileSource, IncrementSpec


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_csv_options_pass_through(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "n;s\n1;x\n2;y\n")
    source = FileSource(str(tmp_path / "in"), "csv",
                        {"header": "true", "inferSchema": "true", "delimiter": ";"})
    df = read_files(spark, source)
    assert df.dtypes == [("n", "int"), ("s", "string")]
    assert unordered(df) == [(1, "x"), (2, "y")]


def test_declared_schema_needs_no_inference(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "n,s\n1,x\nbad,y\n")
    source = FileSource(str(tmp_path / "in"), "csv", {"header": "true"}, schema="n int, s string")
    assert unordered(read_files(spark, source)) == [(1, "x"), (None, "y")]


def test_declared_schema_must_match_the_header(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "s,n\nx,1\n")
    swapped = FileSource(str(tmp_path / "in"), "csv", {"header": "true"}, schema="n int, s string")
    with pytest.raises(Exception, match="CSV header"):
        read_files(spark, swapped).collect()
    forced = replace(swapped, options={"header": "true", "enforceSchema": "true"})
    assert rows(read_files(spark, forced)) == [(None, "1")]


def test_multi_line_json(spark, tmp_path):
    put(tmp_path / "in", "a.json", '[\n {"id": "a",\n  "t": 1.5},\n {"id": "b"}\n]')
    source = FileSource(str(tmp_path / "in"), "json", {"multiLine": "true"})
    assert unordered(read_files(spark, source)) == [("a", 1.5), ("b", None)]


def test_suffix_filter(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "1\n")
    put(tmp_path / "in", "b.txt", "2\n")
    source = FileSource(str(tmp_path / "in"), "csv", schema="n int", suffix=".csv")
    assert rows(read_files(spark, source)) == [(1,)]


def test_parquet_scan_prunes_and_pushes(spark, sf_dir):
    df = read_files(spark, FileSource(f"{sf_dir}/lineitem.parquet", "parquet"))
    text = plan(df.filter("l_quantity > 10").select("l_partkey"))
    assert "GreaterThan(l_quantity,10.0)" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text


def test_lineage_by_path_and_by_file(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "1\n")
    path = str(tmp_path / "in")
    source = FileSource(path, "csv", schema="n int")
    stamped = with_lineage(read_files(spark, source), source)
    assert stamped.columns == ["n", "ingestion_timestamp", "source_file"]
    assert rows(stamped.select("source_file")) == [(path,)]
    tracked = FileSource(path, "csv", schema="n int", track_file=True)
    name = with_lineage(read_files(spark, tracked), tracked).first()["source_file"]
    assert name.startswith("file:") and name.endswith("/a.csv")


@pytest.mark.parametrize("make", [
    lambda: FileSource(""), lambda: FileSource("p", "avro"), lambda: EventSource("p"),
    lambda: CatalogSource(""), lambda: DatabaseSource("q", num_partitions=4),
    lambda: DatabaseSource("q", partition_column="id", lower_bound="1"),
])
def test_sources_check_themselves(make):
    with pytest.raises(ValueError):
        make()


# ---------------------------------------------------------------- query sources


class Reader:
    """Records what a JDBC read is asked for; no database is involved."""

    def __init__(self):
        self.asked = {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def option(self, key, value):
        return self.options(**{key: value})

    def load(self):
        return self.asked


class Session:
    @property
    def read(self):
        return Reader()


DB = DatabaseSource(
    "SELECT id, fee FROM loans WHERE open", url="jdbc:postgresql://h/d",
    user="u", password="secret", fetch_size=500, partition_column="id", num_partitions=4,
    lower_bound="0", upper_bound="1000",
)


def test_jdbc_read_options(monkeypatch):
    for name in ("DB_URL", "DB_USER", "DB_PASSWORD"):
        monkeypatch.delenv(name, raising=False)
    assert read_query(Session(), DB) == {
        "format": "jdbc", "url": "jdbc:postgresql://h/d", "user": "u", "password": "secret",
        "driver": "org.postgresql.Driver", "fetchsize": "500",
        "dbtable": "(SELECT id, fee FROM loans WHERE open) AS source",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "4",
    }


def test_environment_wins_over_the_spec(monkeypatch):
    monkeypatch.setenv("DB_URL", "jdbc:other")
    monkeypatch.setenv("DB_USER", "me")
    monkeypatch.delenv("DB_PASSWORD", raising=False)
    options = jdbc_options(DB)
    assert (options["url"], options["user"], options["password"]) == ("jdbc:other", "me", "secret")


def test_password_is_not_shown():
    assert "secret" not in repr(DB)


def test_one_partition_needs_no_bounds(spark):
    assert partition_options(spark, DatabaseSource("SELECT 1")) == {}


def test_bounds_are_whole_numbers_or_times():
    assert [_bound(b) for b in ("7", "7.90", "1E+3", "2024-01-01", "2024-01-01 10:00:00")] == [
        "7", "7", "1000", "2024-01-01", "2024-01-01 10:00:00"]


def test_parallel_increment_splits_its_window():
    on_mark = replace(DB, partition_column="created_at", increment=IncrementSpec("created_at"))
    window = split_window(on_mark, "2024-01-01", "2024-02-01")
    assert (window.lower_bound, window.upper_bound) == ("2024-01-01", "2024-02-01")
    assert split_window(on_mark, None, "2024-02-01") == on_mark
    other = replace(DB, increment=IncrementSpec("created_at"))
    assert split_window(other, "2024-01-01", "2024-02-01") == other
    assert split_window(source(), "1", "2") == source()


def test_query_is_a_valid_relation(spark):
    spark.range(5).createOrReplaceTempView("numbers")
    relation = as_relation("SELECT id FROM numbers WHERE id > 2")
    assert unordered(spark.sql(f"SELECT * FROM {relation}")) == [(3,), (4,)]


# ---------------------------------------------------------------- high-water marks


def feed(spark, values, schema="k timestamp, v int"):
    spark.createDataFrame(values, schema).createOrReplaceTempView("feed")


def source(column="k"):
    return CatalogSource("SELECT * FROM feed", "feed", IncrementSpec(column))


def day(n):
    return datetime(2024, 1, n)


def test_increments(spark, root):
    control, out = f"{root}/control", f"{root}/bronze"
    feed(spark, [(day(1), 1), (day(2), 2), (None, 9)])
    assert load_increment(spark, source(), control, out) == 3  # with the row that has no mark
    assert load_increment(spark, source(), control, out) == 0
    feed(spark, [(day(1), 1), (day(2), 2), (day(3), 3), (day(2), 4), (None, 9), (None, 8)])
    # the new mark, and two late rows: one with the old mark, one without any
    assert load_increment(spark, source(), control, out) == 3
    assert load_increment(spark, source(), control, out) == 0
    assert unmarked_rows(spark, source()) == 2
    bronze = spark.read.parquet(out)
    assert unordered(bronze.select("v")) == [(1,), (2,), (3,), (4,), (8,), (9,)]
    assert {"ingestion_timestamp", "source_query", "loaded_after"} <= set(bronze.columns)
    assert spark.read.parquet(control).count() == 2


def control_rows(spark, path):
    return unordered(spark.read.parquet(path).select(
        "load_number", "last_value", "rows", "late_ties", "late_unmarked"))


def test_ties_and_rows_without_a_mark_that_come_late(spark, root):
    """Copies are counted; rows that were there are not loaded again, also when the source has
    been emptied of them in between."""
    control, out = f"{root}/control", f"{root}/bronze"
    feed(spark, [(3, 1), (2, 2)], "k int, v int")
    assert load_increment(spark, source(), control, out) == 2
    feed(spark, [(3, 1), (3, 1), (3, 5), (None, 7), (None, 7)], "k int, v int")
    assert load_increment(spark, source(), control, out) == 4
    feed(spark, [(3, 6), (None, 8)], "k int, v int")
    assert load_increment(spark, source(), control, out) == 2
    feed(spark, [(3, 1), (3, 1), (3, 5), (3, 6), (None, 7), (None, 8), (4, 9)], "k int, v int")
    assert load_increment(spark, source(), control, out) == 1
    assert [v for v, in unordered(read_increments(spark, out).select("v"))] == [
        1, 1, 2, 5, 6, 7, 7, 8, 9]
    assert control_rows(spark, control) == [
        (0, "3", 2, 0, 0), (1, "3", 4, 2, 2), (2, "3", 2, 1, 1), (3, "4", 1, 0, 0)]


def test_a_source_without_any_mark_at_first(spark, root):
    control, out = f"{root}/control", f"{root}/bronze"
    feed(spark, [(None, 1)], "k int, v int")
    assert [load_increment(spark, source(), control, out) for _ in range(2)] == [1, 0]
    feed(spark, [(None, 1), (None, 2)], "k int, v int")
    assert load_increment(spark, source(), control, out) == 1
    feed(spark, [(None, 1), (None, 2), (None, 3), (7, 4)], "k int, v int")
    assert [load_increment(spark, source(), control, out) for _ in range(2)] == [2, 0]
    assert [v for v, in unordered(read_increments(spark, out).select("v"))] == [1, 2, 3, 4]


def test_a_source_that_grew_a_column(spark, root):
    control, out = f"{root}/control", f"{root}/bronze"
    feed(spark, [(1, 1), (1, 1)], "k int, v int")
    load_increment(spark, source(), control, out)
    feed(spark, [(1, 1, {"a": 1}), (1, 1, {"a": 2}), (1, 1, None), (1, 2, None)],
         "k int, v int, w map<string,int>")
    assert load_increment(spark, source(), control, out) == 2
    assert read_increments(spark, out).count() == 4


def test_bounds_of_windows_are_text(spark, root):
    feed(spark, [("007", 1)], "k string, v int")
    load_increment(spark, source(), f"{root}/c", f"{root}/b")
    feed(spark, [("008", 2)], "k string, v int")
    load_increment(spark, source(), f"{root}/c", f"{root}/b")
    bronze = read_increments(spark, f"{root}/b")
    assert unordered(bronze.select("v", "loaded_after")) == [(1, None), (2, "007")]


def test_late_rows_read_only_what_can_hold_them(spark, root):
    control, out = f"{root}/control", f"{root}/bronze"
    for n in (1, 2, 3):
        feed(spark, [(k, k) for k in range(n + 1)], "k int, v int")
        load_increment(spark, source(), control, out)
    text = plan(late_rows(spark, source(), "3", out, 3, 2))
    assert "load_number" in text.split("PartitionFilters")[1]
    assert "EqualTo(k,3)" in text


def test_a_window_is_replaced_when_the_mark_did_not_move(spark, root, monkeypatch):
    control, out = f"{root}/control", f"{root}/bronze"
    feed(spark, [(day(1), 1)])
    load_increment(spark, source(), control, out)
    feed(spark, [(day(1), 1), (day(2), 2)])
    with monkeypatch.context() as broken:
        broken.setattr("trilode.sources.queries.write_mark", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_increment(spark, source(), control, out)
    feed(spark, [(day(1), 1), (day(2), 2), (day(3), 3)])
    assert load_increment(spark, source(), control, out) == 2
    assert unordered(spark.read.parquet(out).select("v")) == [(1,), (2,), (3,)]


def test_empty_source_makes_an_empty_bronze(spark, root):
    control, out = f"{root}/control", f"{root}/bronze"
    feed(spark, [])
    assert load_increment(spark, source(), control, out) == 0
    assert spark.read.parquet(out).count() == 0
    feed(spark, [(day(1), 1)])
    assert load_increment(spark, source(), control, out) == 1
    assert unordered(spark.read.parquet(out).select("v")) == [(1,)]


@pytest.mark.parametrize("schema, low, high", [
    ("k bigint, v int", 1, 2**60), ("k decimal(20,4), v int", 1, 2), ("k date, v int",
     day(1).date(), day(2).date()), ("k string, v int", "o'a", "o'b"), ("k double, v int", 0.1, 0.3),
])
def test_marks_of_any_type(spark, root, schema, low, high):
    from decimal import Decimal

    if "decimal" in schema:
        low, high = Decimal(low), Decimal(high)
    feed(spark, [(low, 1)], schema)
    assert load_increment(spark, source(), f"{root}/c", f"{root}/b") == 1
    feed(spark, [(low, 1), (high, 2)], schema)
    assert load_increment(spark, source(), f"{root}/c", f"{root}/b") == 1
    assert load_increment(spark, source(), f"{root}/c", f"{root}/b") == 0


def test_bounds_reach_the_scan(spark, root, sf_dir):
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("feed")
    write_mark(spark, f"{root}/control", "feed", "o_orderkey", "500")
    step = plan_increment(spark, source("o_orderkey"), f"{root}/control")
    text = plan(step.rows)
    assert "GreaterThan(o_orderkey,500)" in text and "LessThanOrEqual(o_orderkey," in text


def test_time_marks_survive_a_zone_change(spark):
    df = spark.sql("SELECT timestamp'2024-06-01 12:00:00.123456 UTC' AS t")
    text = df.select(mark_text(F.col("t"), df.schema["t"].dataType)).first()[0]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        same = spark.sql(f"SELECT CAST('{text}' AS TIMESTAMP) = "
                         "timestamp'2024-06-01 12:00:00.123456 UTC'")
        assert same.first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_latest_mark_wins(spark, root):
    control = f"{root}/control"
    assert last_mark(spark, control, "a", "k") is None
    for value in ("9", "10"):
        write_mark(spark, control, "a", "k", value)
    write_mark(spark, control, "b", "k", "77")
    assert last_mark(spark, control, "a", "k") == "10"
    assert last_mark(spark, control, "a", "other") is None


def test_ensure_table_keeps_what_is_there(spark, root):
    ensure_table(spark, f"{root}/t", "n int")
    assert spark.read.parquet(f"{root}/t").count() == 0
    spark.range(3).select(F.col("id").cast("int").alias("n")).write.mode("append").parquet(
        f"{root}/t")
    ensure_table(spark, f"{root}/t", "n int")
    assert spark.read.parquet(f"{root}/t").count() == 3


# ---------------------------------------------------------------- samples


def test_inline_rows_keep_types(spark):
    df = inline_rows(spark, [(None, 1), (None, 2)], "a string, b bigint")
    assert df.dtypes == [("a", "string"), ("b", "bigint")]


def test_sales_sample(spark):
    df = sales_sample(spark, 1000, seed=1)
    assert df.count() == 1010
    assert df.filter("product IS NULL").count() == 20
    assert df.dropDuplicates().count() >= 1000 - 5
    assert df.filter("quantity NOT BETWEEN 1 AND 10 OR unit_price NOT BETWEEN 10 AND 1000").isEmpty()
    assert df.filter("transaction_date NOT BETWEEN '2024-01-01' AND '2024-03-31'").isEmpty()
    assert df.select("product").distinct().count() == 8


def test_sales_rows_depend_on_the_id_alone(spark):
    ids = spark.range(500)
    assert unordered(sales_rows(ids)) == unordered(sales_rows(ids.repartition(7)))
    assert unordered(sales_rows(ids)) != unordered(sales_rows(ids, seed=7))


def uneven(spark):
    spark.sql("""SELECT CASE WHEN id % 10 <> 0 THEN power(id, 5) END AS x, id,
                        DATE'2024-01-01' + CAST(sqrt(id) AS int) AS day FROM range(1000)
              """).createOrReplaceTempView("uneven")
    return CatalogSource("SELECT * FROM uneven")


@pytest.mark.parametrize("column", ["x", "id", "day"])
def test_quantile_predicates_cover_every_row_once(spark, column):
    source = uneven(spark)
    conditions = split_predicates(spark, source, column, 8)
    sizes = [spark.sql(f"{source.query} WHERE {c}").count() for c in conditions]
    assert sum(sizes) == 1000 and max(sizes) <= 2 * 1000 / 8
    held = " + ".join(f"CAST(coalesce({c}, false) AS int)" for c in conditions)
    assert spark.sql(f"SELECT 1 FROM uneven WHERE {held} <> 1").count() == 0


def test_ranks_in_the_database_cut_evenly(spark):
    source = uneven(spark)  # the text a database gets, run by Spark
    cuts = sorted(r[0] for r in spark.sql(rank_query(source, "x", 4)).collect())
    assert len(cuts) == 4 and cuts[0] == 1.0
    edges = [*cuts, float("inf")]
    sizes = [spark.sql(f"SELECT 1 FROM uneven WHERE x >= {a!r}D AND x < {b}").count()
             for a, b in zip(cuts, [f"{c!r}D" for c in cuts[1:]] + ["double('inf')"])]
    assert len(edges) == 5 and sizes == [225] * 4
    inside = spark.sql(rank_query(source, "id", 2, "id BETWEEN 100 AND 199")).collect()
    assert sorted(r[0] for r in inside) == [100, 150]


def test_quantiles_of_hardly_anything(spark):
    spark.sql("SELECT CAST(NULL AS int) AS x").createOrReplaceTempView("no_value")
    assert split_predicates(spark, CatalogSource("SELECT * FROM no_value"), "x", 8) == ["1 = 1"]
    spark.sql("SELECT 7 AS x FROM range(50)").createOrReplaceTempView("one_value")
    source = CatalogSource("SELECT * FROM one_value")
    sizes = [spark.sql(f"{source.query} WHERE {c}").count()
             for c in split_predicates(spark, source, "x", 4)]
    assert sorted(sizes)[-1] == 50 and sum(sizes) == 50
    assert split_predicates(spark, source, "x", 1) == ["1 = 1"]


def test_unknown_split_is_refused():
    with pytest.raises(ValueError, match="split"):
        DatabaseSource("SELECT 1", partition_column="x", num_partitions=2, split="hash")
