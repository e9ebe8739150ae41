"""Query sources: one SQL text, run over JDBC or over the session catalog, whole or incremental."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, replace
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilode.sinks.write import write_table, written_rows
from trilode.sources.control import last_mark, mark_text, newest_mark, write_mark
from trilode.sources.lineage import INGESTED_AT, SOURCE_QUERY, with_lineage
from trilode.spec import UNNAMED, CatalogSource, DatabaseSource, SinkSpec

LOADED_AFTER = "loaded_after"
LOAD_NUMBER = "load_number"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's directory name for a NULL partition value


UNSPLIT = {"num_partitions": 1, "lower_bound": None, "upper_bound": None}


def has_readers(source: CatalogSource) -> bool:
    return isinstance(source, DatabaseSource) and source.num_partitions > 1


def as_relation(query: str) -> str:
    return f"({query}) AS source"


def jdbc_options(source: DatabaseSource) -> dict[str, str]:
    """Connection options; ``DB_URL``, ``DB_USER`` and ``DB_PASSWORD`` win over the spec."""
    return {
        "url": os.getenv("DB_URL", source.url),
        "user": os.getenv("DB_USER", source.user),
        "password": os.getenv("DB_PASSWORD", source.password),
        "driver": source.driver,
        "fetchsize": str(source.fetch_size),
    }


def _one_row(
    spark: SparkSession, source: CatalogSource, select: str, where: str | None = None
) -> DataFrame:
    """An aggregate over the source query, computed where the data is."""
    query = f"SELECT {select} FROM {as_relation(source.query)}"
    if where:
        query += f" WHERE {where}"
    if isinstance(source, DatabaseSource):
        reader = spark.read.format("jdbc").options(**jdbc_options(source))
        return reader.option("dbtable", as_relation(query)).load()
    return spark.sql(query)


def partition_options(spark: SparkSession, source: DatabaseSource) -> dict[str, str]:
    """Range-split options, so that a large read is not one task; bounds only set the stride."""
    if source.num_partitions <= 1:
        return {}
    column = source.partition_column
    low, high = source.lower_bound, source.upper_bound
    if low is None:
        bounds = _one_row(spark, source, f"MIN({column}) AS low, MAX({column}) AS high").first()
        if bounds[0] is None:
            return {}
        low, high = str(bounds[0]), str(bounds[1])
    return {
        "partitionColumn": column,
        "lowerBound": _bound(low),
        "upperBound": _bound(high),
        "numPartitions": str(source.num_partitions),
    }


def rank_query(
    source: CatalogSource, column: str, parts: int, window: str | None = None
) -> str:
    """The least value of each of ``parts`` equal shares of the rows, NULL left out."""
    where = f"{column} IS NOT NULL" + (f" AND {window}" if window else "")
    ranked = (f"SELECT {column} AS cut, NTILE({parts}) OVER (ORDER BY {column}) AS part "
              f"FROM {as_relation(source.query)} WHERE {where}")
    return f"SELECT MIN(cut) AS cut FROM ({ranked}) AS ranked GROUP BY part"


def cut_points(spark: SparkSession, source: CatalogSource, column: str, parts: int) -> list[str]:
    """SQL literals that cut the source's rows by ``column`` into about equal parts, rising.

    The values come as one small result: a database numbers its rows by rank, Spark takes approximate
    percentiles (of numbers, dates and times).
    """
    if isinstance(source, DatabaseSource):
        window = None
        if source.lower_bound is not None:
            kind = _one_row(spark, source, f"{column} AS cut", "1 = 0").schema["cut"].dataType
            low, high = (mark_literal(b, kind) for b in (source.lower_bound, source.upper_bound))
            window = f"{column} BETWEEN {low} AND {high}"
        reader = spark.read.format("jdbc").options(**jdbc_options(source))
        query = rank_query(source, column, parts, window)
        cuts = reader.option("dbtable", as_relation(query)).load()
    else:
        shares = ", ".join(f"{k}D / {parts}" for k in range(1, parts))
        cuts = _one_row(spark, source, f"percentile_approx({column}, array({shares})) AS cuts")
        cuts = cuts.select(F.explode("cuts").alias("cut"))
    kind = cuts.schema["cut"].dataType
    values = sorted({row.cut for row in cuts.collect() if row.cut is not None and row.cut == row.cut})
    if isinstance(source, DatabaseSource):
        values = values[1:]  # the least value of all cuts nothing off
    return [mark_literal(str(value), kind) for value in values]


def split_predicates(
    spark: SparkSession, source: CatalogSource, column: str, parts: int
) -> list[str]:
    """Conditions of which every row meets exactly one; rows with NULL have one of their own."""
    cuts = cut_points(spark, source, column, parts) if parts > 1 else []
    if not cuts:
        return ["1 = 1"]
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]}", *between, f"{column} >= {cuts[-1]}", f"{column} IS NULL"]


def _bound(value: str) -> str:
    """Spark takes whole numbers, dates and times as bounds."""
    try:
        return str(int(Decimal(value)))
    except InvalidOperation:
        return value


def split_window(source: CatalogSource, last: str | None, upper: str) -> CatalogSource:
    """Spread the parallel readers over the window when they split on the mark column."""
    on_mark = getattr(source, "partition_column", None) == source.increment.column
    if last is None or not on_mark:
        return source
    return replace(source, lower_bound=last, upper_bound=upper)


def read_query(spark: SparkSession, source: CatalogSource) -> DataFrame:
    if not isinstance(source, DatabaseSource):
        return spark.sql(f"SELECT * FROM {as_relation(source.query)}")
    if source.split == "quantile" and has_readers(source):
        options = jdbc_options(source)
        return spark.read.jdbc(
            options.pop("url"), as_relation(source.query), properties=options,
            predicates=split_predicates(
                spark, source, source.partition_column, source.num_partitions))
    return (
        spark.read.format("jdbc")
        .options(**jdbc_options(source))
        .options(**partition_options(spark, source))
        .option("dbtable", as_relation(source.query))
        .load()
    )


def mark_literal(last: str, dtype: T.DataType) -> str:
    """A mark as SQL text, so that the newest value is asked among new rows only."""
    if isinstance(dtype, T.NumericType):
        return last
    quoted = "'" + last.replace("'", "''") + "'"
    kinds = {T.DateType: "DATE ", T.TimestampType: "TIMESTAMP ", T.TimestampNTZType: "TIMESTAMP "}
    return kinds.get(type(dtype), "") + quoted


@dataclass(frozen=True)
class Increment:
    """The rows with ``last < column <= upper``; the first window also has the rows without a mark.

    ``upper`` is None when there is nothing new.
    """

    rows: DataFrame
    last: str | None
    upper: str | None


def plan_increment(spark: SparkSession, source: CatalogSource, control_path: str) -> Increment:
    """Fix the window first, so every retry and every parallel reader sees the same bounds.

    The bounds are plain filters on the scan; a JDBC source receives them in its WHERE clause. Rows
    that turn up late with the mark ``last`` or without any are for :func:`late_rows`. A parallel
    read should split on the mark column: the ranges then divide the window, not the whole table.
    """
    if source.name == UNNAMED:
        raise ValueError("an incremental source needs a name of its own for its high-water mark")
    column = source.increment.column
    last = last_mark(spark, control_path, source.name, column)
    whole = _unsplit(spark, source)
    dtype = whole.select(column).schema.fields[0].dataType
    newest = F.col("newest").cast(dtype)
    past = F.lit(True) if last is None else newest > F.lit(last).cast(dtype)
    new_only = None if last is None else f"{column} > {mark_literal(last, dtype)}"
    top = _one_row(spark, source, f"MAX({column}) AS newest", new_only)
    found = top.filter(past).select(mark_text(newest, dtype)).first()
    upper = found[0] if found else None
    if upper is None:
        return Increment(whole.filter(F.lit(False)), last, None)
    rows = read_query(spark, split_window(source, last, upper))
    within = F.col(column) <= F.lit(upper).cast(dtype)
    if last is None:
        return Increment(rows.filter(within | F.col(column).isNull()), last, upper)
    return Increment(rows.filter(within & (F.col(column) > F.lit(last).cast(dtype))), last, upper)


def _unsplit(spark: SparkSession, source: CatalogSource) -> DataFrame:
    return read_query(spark, replace(source, **UNSPLIT) if has_readers(source) else source)


def unmarked_rows(spark: SparkSession, source: CatalogSource) -> int:
    """Rows of the source whose mark column is NULL."""
    column = source.increment.column
    return _one_row(spark, source, "COUNT(*) AS n", f"{column} IS NULL").first()[0]


def read_increments(spark: SparkSession, out: str) -> DataFrame:
    """Bronze of an incremental source. The lower bound of a window is text, which Spark would
    otherwise guess a type for: ``007`` is no number."""
    kinds = {LOADED_AFTER: T.StringType(), LOAD_NUMBER: T.LongType()}
    found = spark.read.parquet(out).schema
    fixed = [T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found]
    return spark.read.schema(T.StructType(fixed)).parquet(out)


def _at_mark(source: CatalogSource, last: str | None, dtype: T.DataType) -> Column:
    column = F.col(source.increment.column)
    return F.lit(False) if last is None else column == F.lit(last).cast(dtype)


def not_held(found: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of ``found`` beyond those in ``held``, copies counted.

    Columns that ``held`` lacks, as a source that has grown may have, are not compared; maps
    cannot be.
    """
    same = [f.name for f in found.schema
            if f.name in held.columns and not re.search(r"\b(map<|variant\b)", f.dataType.simpleString())]
    if same == found.columns:
        return found.exceptAll(held.select(*[F.col(c).cast(found.schema[c].dataType) for c in same]))
    copy = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(1)))
    left = found.withColumn("__copy", copy).alias("l")
    right = held.withColumn("__copy", copy).select(*same, "__copy").alias("r")
    equal = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*same, "__copy"]]
    return left.join(right, equal, "left_anti").drop("__copy")


def late_rows(
    spark: SparkSession, source: CatalogSource, last: str | None, out: str, loads: int, reached: int
) -> DataFrame | None:
    """Rows that were not there when their mark was passed: those with the mark ``last`` and those
    without a mark that committed loads do not hold. None before the first load.

    The source is asked for these marks again each time; rows are compared as a whole, so one that
    was changed under an old mark comes again. Of Bronze, the loads that can hold the mark are read
    (a partition each), and row groups with NULL marks.
    """
    if not loads:
        return None
    whole = _unsplit(spark, source)
    dtype = whole.select(source.increment.column).schema.fields[0].dataType
    missing = F.col(source.increment.column).isNull()
    held = read_increments(spark, out)
    committed = held.filter(F.coalesce(F.col(LOAD_NUMBER), F.lit(0)) < loads)
    known = committed.filter(missing)
    if last is not None:
        at_mark = committed.filter(F.coalesce(F.col(LOAD_NUMBER), F.lit(0)) >= reached)
        known = known.unionByName(at_mark.filter(_at_mark(source, last, dtype)))
    known = known.drop(LOADED_AFTER, LOAD_NUMBER, INGESTED_AT, SOURCE_QUERY)
    # two reads: an OR would keep a database from using an index on the mark
    found = whole.filter(missing)
    if last is not None:
        found = found.unionByName(whole.filter(_at_mark(source, last, dtype)))
    return not_held(found, known)


def load_increment(spark: SparkSession, source: CatalogSource, control_path: str, out: str) -> int:
    """Append the next window and late rows to Bronze, then move the mark; returns the rows written.

    A load lives in a partition named after its lower bound and its number. If a run dies before its
    row is in the control table, the next run has the same number and replaces that partition, so
    nothing is loaded twice and no committed row is ever touched. The control row says how many rows
    came late (:func:`late_rows`), with the last mark and without one.
    """
    step = plan_increment(spark, source, control_path)
    column = source.increment.column
    mark = newest_mark(spark, control_path, source.name, column)
    if step.upper is None and not mark.loads:
        empty = _stamped(step.rows, source, None, 0).drop(LOADED_AFTER, LOAD_NUMBER).limit(0)
        first = f"{out.rstrip('/')}/{LOADED_AFTER}={NO_VALUE}/{LOAD_NUMBER}=0"
        empty.write.mode("ignore").parquet(first)
        if not unmarked_rows(spark, source):
            return 0
    dtype = step.rows.select(column).schema.fields[0].dataType
    rows = step.rows
    if not mark.loads:
        if step.upper is None:  # rows without a mark only
            rows = _unsplit(spark, source)
    else:
        late = late_rows(spark, source, step.last, out, mark.loads, mark.reached)
        if step.upper is not None and step.last is None:  # the first marks after loads without any
            rows = rows.filter(F.col(column).isNotNull())
        rows = rows.unionByName(late)
    sink = SinkSpec(
        path=out,
        options={"compression": "snappy", "partitionOverwriteMode": "dynamic"},
        partition_by=(LOADED_AFTER, LOAD_NUMBER),
        rebalance=False,  # a load has one partition value
    )
    seen = Observation()
    late_here = F.lit(bool(mark.loads))
    observed = _stamped(rows, source, step.last, mark.loads).observe(
        seen, F.count(F.lit(1)).alias("rows"),
        F.count_if(late_here & _at_mark(source, step.last, dtype)).alias("ties"),
        F.count_if(late_here & F.col(column).isNull()).alias("unmarked"))
    write_table(observed, sink)
    counts = seen.get
    if counts["rows"]:
        upper = step.upper if step.upper is not None else step.last
        write_mark(spark, control_path, source.name, column, upper, mark.loads, counts["rows"],
                   counts["ties"], counts["unmarked"])
    return counts["rows"]


def _stamped(rows: DataFrame, source: CatalogSource, last: str | None, load: int) -> DataFrame:
    return with_lineage(rows, source).withColumns(
        {LOADED_AFTER: F.lit(last).cast("string"), LOAD_NUMBER: F.lit(load).cast("bigint")})


def load_query(spark: SparkSession, source: CatalogSource, out: str) -> int:
    """The whole query into Bronze, replacing what is there."""
    rows = with_lineage(read_query(spark, source), source)
    return written_rows(rows, SinkSpec(path=out, options={"compression": "snappy"}))
