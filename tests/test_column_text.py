"""Column text in Python notation against the same expression built from Columns."""

import datetime

import pytest
from pyspark.sql import functions as F

from trilode.functions.column_text import as_sql, is_column_text, to_sql

ROWS = [(1, 5.0, "a.b", "PAID", True, "2024-01-05"), (2, None, "o'x", "OPEN", False, "bad"),
        (3, 0.0, None, None, None, "2030-02-01"), (4, -1.5, "abc", "PAID", True, None)]
col, lit, when = F.col, F.lit, F.when


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        ROWS, "id int, amount double, name string, status string, flag boolean, day string")


@pytest.mark.parametrize("text", [
    "col('amount') > 0",
    "(col('amount') >= 0) & (col('status') == 'PAID') | ~col('flag')",
    "col('status').isin(['PAID', 'OPEN'])",
    "col('status').isin('PAID', 'x')",
    "col('amount').between(-2, 5)",
    "col('name').rlike('^[a-z]\\\\.b$')",
    "col('name') == \"o'x\"",
    "when(col('flag'), col('amount')).when(col('id') == 3, -1).otherwise(lit(0)) + 1",
    "col('name').isNotNull()",
    "F.col('id') * 2 - 1",
    "col('flag').isin([True])",
])
def test_predicates_and_values(df, text):
    assert is_column_text(text)
    want = df.select(eval(text, {"col": col, "lit": lit, "when": when, "F": F})).collect()
    assert df.selectExpr(to_sql(text)).collect() == want


@pytest.mark.parametrize("text, value", [
    ("sum('amount')", 3.5), ("count('*')", 4), ("count('amount')", 3), ("countDistinct('status')", 2),
    ("avg(when(col('flag'), col('amount')))", 1.75), ("max('id') / lit(2)", 2.0),
    ("sum('amount') / lit(0)", None), ("min(col('amount')).alias('x')", -1.5),
])
def test_aggregates(df, text, value):
    assert df.agg(F.expr(as_sql(text))).first()[0] == value


@pytest.mark.parametrize("text, values", [
    ("col('name').cast('double')", [None] * 4), ("col('amount').cast('int')", [5, None, 0, -1]),
    ("to_date('day')", [datetime.date(2024, 1, 5), None, datetime.date(2030, 2, 1), None]),
    ("to_date(col('day'), 'yyyy-MM-dd')",
     [datetime.date(2024, 1, 5), None, datetime.date(2030, 2, 1), None]),
    ("to_date(col('day')) <= current_date()", [True, None, False, None]),
    ("to_timestamp('day') > to_timestamp(lit('2025-01-01'))", [False, None, True, None]),
])
def test_casts_give_null(df, text, values):
    assert [r[0] for r in df.selectExpr(as_sql(text)).collect()] == values


@pytest.mark.parametrize("text, values", [
    ("col('t').cast('int')", [12, -3, None, 7, None]), ("col('t').cast('bigint')", [12, -3, None, 7, None]),
    ("col('t').cast('smallint')", [12, -3, None, 7, None]),
    ("col('big').cast('long')", [9007199254740993, 1, None, 2, 3]),
])
def test_whole_numbers_from_text_with_a_fraction(spark, text, values):
    """As a cast without ANSI mode reads them."""
    texts = spark.createDataFrame(
        [("12.5", "9007199254740993.5"), ("-3.9", "1"), ("abc", "x"), (" 7 ", "2"), (None, "3")],
        "t string, big string")
    assert [r[0] for r in texts.selectExpr(as_sql(text)).collect()] == values
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert [r[0] for r in texts.select(eval(text, {"col": col})).collect()] == values
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("text", [
    "round(col('amount'), 1)", "abs(col('amount'))", "upper(col('name'))", "length(trim(col('name')))",
    "coalesce(col('amount'), lit(9.0))", "concat(col('name'), lit('-'), col('status'))",
    "greatest(col('id'), lit(2))", "col('name').startswith('a')", "col('name').contains(\"'\")",
    "col('status').like('P%')", "col('name').substr(1, 2)", "floor(col('amount')) + ceil(col('amount'))",
])
def test_scalar_functions(df, text):
    want = df.select(eval(text, vars(F).copy())).collect()
    assert df.selectExpr(as_sql(text)).collect() == want


@pytest.mark.parametrize("text, value", [
    ("round(avg('amount'), 2)", 1.17), ("abs(min('amount'))", 1.5),
    ("coalesce(sum(when(col('id') > 9, col('amount'))), lit(0))", 0.0),
    ("round(stddev_pop('id'), 3)", 1.118), ("mean('id')", 2.5), ("count_distinct('status')", 2),
])
def test_functions_of_aggregates(df, text, value):
    assert df.agg(F.expr(as_sql(text))).first()[0] == value


@pytest.mark.parametrize("text", ["round(col('a'), 1, 2)", "upper()", "col('a').startswith()",
                                  "collect_list(col('a'))", "sqrt(col('a'), col('b'))"])
def test_wrong_arguments_are_refused(text):
    with pytest.raises(ValueError):
        to_sql(text)


@pytest.mark.parametrize("text", ["amount > 0", "sum(amount)", "status IN ('a')", "count(*)",
                                  "CASE WHEN a THEN b END", "try_cast(x AS INT)", "a AND b"])
def test_sql_stays(text):
    assert as_sql(text) == text


@pytest.mark.parametrize("text", ["col('a').foo()", "__import__('os').system('x') + col('a')",
                                  "col('a', 'b')", "[col('a')]", "lambda: col('a')", "col(x)",
                                  "col('a').cast('int) + x(')", "1 < col('a') < 3"])
def test_anything_else_is_refused(text):
    with pytest.raises(ValueError):
        to_sql(text)
