"""Scans, landing and lineage."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.checks.dirt import dirty
from trilode.checks.registry import check, table, workspace
from trilode.operators import union_all
from trilode.plans.run import read_bronze, read_rescued, run
from trilode.sinks import write_table, written_rows
from trilode.sinks.write import entries, remove
from trilode.sources import (
    inline_rows,
    load_increment,
    load_query,
    read_files,
    read_increments,
    read_layer,
    sales_rows,
    with_lineage,
)
from trilode.sources.lineage import INGESTED_AT, SOURCE_FILE
from trilode.sources.samples import (
    COPY_AT,
    COPY_EVERY,
    DAYS,
    FIRST_DAY,
    MODULUS,
    NULL_EVERY,
    PRODUCTS,
    REGIONS,
)
from trilode.sources.files import RESCUED, rescued_report
from trilode.sources.queries import split_predicates
from trilode.spec import (
    CatalogSource,
    EventSource,
    FileSource,
    FlowSpec,
    IncrementSpec,
    SinkSpec,
)
from trilode.streaming import load_arrivals, read_arrivals

ORDERS_DDL = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)
EVENTS_DDL = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
LINEAGE = (INGESTED_AT, SOURCE_FILE)
ORDERS_SQL = "SELECT * FROM orders"

# microseconds survive the trip through text
TEXT_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _through(spark: SparkSession, sf_dir: str, fmt: str, options: dict[str, str]) -> DataFrame:
    """orders as files of a format, landed in Bronze and read back."""
    folder = workspace(spark, sf_dir, f"bronze_{fmt}")
    landing = f"{folder}/landing"
    write_table(table(spark, sf_dir, "orders"), SinkSpec(landing, format=fmt, options=options))
    source = FileSource(landing, fmt, options, schema=ORDERS_DDL)
    written_rows(
        with_lineage(read_files(spark, source), source),
        SinkSpec(f"{folder}/bronze", options={"compression": "snappy"}),
    )
    return read_layer(spark, f"{folder}/bronze").drop(*LINEAGE)


@check(ORDERS_SQL)
def bronze_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "csv", {"header": "true", "delimiter": ",", **TEXT_TIME})


@check(ORDERS_SQL)
def bronze_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "json", TEXT_TIME)


@check(ORDERS_SQL)
def bronze_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through(spark, sf_dir, "parquet", {})


@check("SELECT count(*) AS landed, true AS stamped, count(*) AS named FROM orders")
def bronze_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row knows when it came in and from which file."""
    source = FileSource(f"{sf_dir.rstrip('/')}/orders.parquet", "parquet", track_file=True)
    landed = with_lineage(read_files(spark, source), source)
    return landed.agg(
        F.count(F.lit(1)).alias("landed"),
        (F.count_if(F.col(INGESTED_AT).isNull()) == 0).alias("stamped"),
        F.count_if(F.col(SOURCE_FILE).endswith(".parquet")).alias("named"),
    )


@check("SELECT * FROM orders UNION ALL SELECT * FROM orders")
def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = workspace(spark, sf_dir, "bronze_append")
    orders = table(spark, sf_dir, "orders")
    write_table(orders, SinkSpec(out))
    write_table(orders, SinkSpec(out, mode="append"))
    return read_layer(spark, out)


@check(
    """SELECT c_name AS name, c_nationkey AS nation FROM customer
       UNION ALL SELECT s_name AS name, s_nationkey AS nation FROM supplier"""
)
def bronze_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds with their columns in different order."""
    buyers = table(spark, sf_dir, "customer").selectExpr("c_name name", "c_nationkey nation")
    sellers = table(spark, sf_dir, "supplier").selectExpr("s_nationkey nation", "s_name name")
    return union_all(buyers, sellers)


UNPROCESSED = "SELECT * FROM trilode_queue WHERE processed = false"


@check(
    f"""SELECT o_orderkey, o_totalprice, o_orderstatus = 'F' AS processed,
               '{UNPROCESSED}' AS source_query
        FROM orders WHERE NOT o_orderstatus = 'F'"""
)
def bronze_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unprocessed rows of a queue table, through a SQL query source."""
    queue = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").alias("processed")
    )
    queue.createOrReplaceTempView("trilode_queue")
    out = workspace(spark, sf_dir, "bronze_query")
    load_query(spark, CatalogSource(UNPROCESSED), out)
    return read_layer(spark, out).drop(INGESTED_AT)


@check(
    """SELECT o_orderkey, o_orderdate, o_totalprice,
              CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN
                (SELECT CAST(max(o_orderdate) AS DATE) FROM orders
                 WHERE o_orderdate < TIMESTAMP '1998-01-01') END AS loaded_after
       FROM orders"""
)
def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads past a high-water mark: a first part, the rest, nothing new."""
    folder = f"{workspace(spark, sf_dir, 'bronze_incremental')}/{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    source = CatalogSource(
        "SELECT * FROM trilode_feed", name="orders", increment=IncrementSpec("o_orderdate")
    )
    for arrived in (orders.filter("o_orderdate < TIMESTAMP '1998-01-01'"), orders, orders):
        arrived.createOrReplaceTempView("trilode_feed")
        load_increment(spark, source, f"{folder}/control", f"{folder}/bronze")
    bronze = read_layer(spark, f"{folder}/bronze")
    return bronze.select(
        "o_orderkey", "o_orderdate", "o_totalprice", F.col("loaded_after").cast("date")
    )


# the mark is the year; every 50th row has none
YEARS = """
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderkey % 50 > 2 THEN CAST(year(o_orderdate) AS INT) END AS year
FROM orders
"""
_EVEN = "o_orderkey % 2 = 0"


@check(
    f"""SELECT *, CAST(CASE
              WHEN year IS NULL THEN CASE WHEN {_EVEN} THEN 0 WHEN o_orderkey % 4 = 1 THEN 1 ELSE 2 END
              WHEN year < 1994 OR (year = 1994 AND {_EVEN}) THEN 0
              WHEN year < 1996 OR (year = 1996 AND {_EVEN}) THEN 1 ELSE 2 END AS BIGINT) AS load_number
        FROM ({YEARS}) y"""
)
def bronze_incremental_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads past a high-water mark, where more rows of the newest year and rows without a mark
    turn up between them; the last load finds nothing new."""
    folder = f"{workspace(spark, sf_dir, 'bronze_incremental_ties')}/{uuid.uuid4().hex}"
    feed = dirty(spark, sf_dir, YEARS)
    source = CatalogSource(
        "SELECT * FROM trilode_years", name="orders", increment=IncrementSpec("year")
    )
    arrivals = (
        f"year < 1994 OR (({_EVEN}) AND (year = 1994 OR year IS NULL))",
        f"year < 1996 OR (year = 1996 AND {_EVEN}) OR (year IS NULL AND o_orderkey % 4 <> 3)",
        "true", "true",
    )
    for arrived in arrivals:
        feed.filter(arrived).createOrReplaceTempView("trilode_years")
        load_increment(spark, source, f"{folder}/control", f"{folder}/bronze")
    bronze = read_increments(spark, f"{folder}/bronze")
    return bronze.select("o_orderkey", "o_totalprice", "year", "load_number")


@check("SELECT * FROM events")
def bronze_stream_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint is lost between two drops; the batches of the new one go beside the old."""
    folder = f"{workspace(spark, sf_dir, 'bronze_stream_reset')}/{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events")
    views = F.coalesce(F.col("event_type") == "view", F.lit(False))
    drop = SinkSpec(f"{folder}/landing", format="json", mode="append", options=TEXT_TIME)
    source = EventSource(
        drop.path, "json", drop.options, schema=EVENTS_DDL, suffix=".json",
        track_file=True, after_reset="new_files",
    )
    for part in (events.filter(views), events.filter(~views)):
        write_table(part, drop)
        load_arrivals(spark, source, f"{folder}/bronze", f"{folder}/checkpoint")
        remove(spark, f"{folder}/checkpoint")
    return read_arrivals(spark, source, f"{folder}/bronze").drop(*LINEAGE)


@check("SELECT *, 0 AS waiting, true AS capped FROM events")
def bronze_archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies in the archive after a load of six files in batches of two: all of it."""
    folder = f"{workspace(spark, sf_dir, 'bronze_archived')}/{uuid.uuid4().hex}"
    drop = SinkSpec(f"{folder}/landing", format="csv", options={"header": "true", **TEXT_TIME})
    write_table(table(spark, sf_dir, "events").repartition(6, "event_id"), drop)
    source = EventSource(
        drop.path, "csv", drop.options, schema=EVENTS_DDL, suffix=".csv",
        max_files_per_trigger=2, archive_dir=f"{folder}/processed",
    )
    batches: list[int] = []
    load_arrivals(spark, source, f"{folder}/bronze", f"{folder}/checkpoint", batches.append)
    waiting = [n for n in entries(spark, drop.path) if n.endswith(".csv")]
    archive = FileSource(source.archive_dir, "csv", drop.options, schema=EVENTS_DDL)
    return read_files(spark, archive).withColumns(
        {"waiting": F.lit(len(waiting)), "capped": F.lit(len(batches) >= 3)})


@check("SELECT *, true AS from_csv FROM events")
def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of CSV files with strangers among them, each ingested once by its own run."""
    folder = f"{workspace(spark, sf_dir, 'bronze_stream')}/{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events")
    views = F.coalesce(F.col("event_type") == "view", F.lit(False))
    drop = SinkSpec(
        f"{folder}/landing", format="csv", mode="append", options={"header": "true", **TEXT_TIME}
    )
    source = EventSource(
        drop.path, "csv", drop.options, schema=EVENTS_DDL, suffix=".csv", track_file=True,
        max_files_per_trigger=1000, archive_dir=f"{folder}/processed",
    )
    events.select("props").write.mode("append").text(drop.path)
    for part in (events.filter(views), events.filter(~views)):
        write_table(part, drop)
        load_arrivals(spark, source, f"{folder}/bronze", f"{folder}/checkpoint")
    bronze = read_arrivals(spark, source, f"{folder}/bronze").drop(INGESTED_AT)
    return bronze.withColumn("from_csv", F.col(SOURCE_FILE).endswith(".csv")).drop(SOURCE_FILE)


@check("SELECT * FROM events")
def bronze_event_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing prefix read whole and appended, without a checkpoint."""
    folder = workspace(spark, sf_dir, "bronze_event_prefix")
    drop = SinkSpec(f"{folder}/incoming", format="json", options=TEXT_TIME)
    write_table(table(spark, sf_dir, "events"), drop)
    source = EventSource(
        drop.path, "json", drop.options, schema=EVENTS_DDL, suffix=".json", streaming=False
    )
    rows = with_lineage(read_files(spark, source), source)
    write_table(rows.limit(0), SinkSpec(f"{folder}/bronze"))
    write_table(rows, replace(SinkSpec(f"{folder}/bronze"), mode="append"))
    return read_layer(spark, f"{folder}/bronze").drop(*LINEAGE)


def _drawn(draw: int, n: int) -> str:
    mixed = f"((o_orderkey % {MODULUS}) * 7919 + 42 * 104729 + {draw} * 611953) % {MODULUS}"
    return f"((({mixed}) * ({mixed}) + ({mixed}) * 31 + 17) % {MODULUS} % {n})"


def _picked(names, draw: int) -> str:
    return f"({list(names)})[{_drawn(draw, len(names))} + 1]"


@check(
    f"""SELECT CAST(CAST('{FIRST_DAY}' AS DATE) + CAST({_drawn(0, DAYS)} AS INT) AS TIMESTAMP)
               AS transaction_date,
           CASE WHEN o_orderkey % {NULL_EVERY} <> 0 THEN {_picked(PRODUCTS, 1)} END AS product,
           {_picked(REGIONS, 2)} AS region,
           CAST({_drawn(3, 10)} + 1 AS INT) AS quantity,
           (1000 + {_drawn(4, 99_001)}) / 100 AS unit_price,
           round((1 + {_drawn(3, 10)}) * ((1000 + {_drawn(4, 99_001)}) / 100), 2) AS total_amount
        FROM (SELECT o_orderkey FROM orders UNION ALL
              SELECT o_orderkey FROM orders WHERE o_orderkey % {COPY_EVERY} = {COPY_AT})"""
)
def samples_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic sales for the order keys."""
    return sales_rows(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")))


# Lines of orders: one in ten is too short, one too long, and one has a key that is no number.
RESCUED_CSV = """CASE o_orderkey % 10
    WHEN 1 THEN concat(o_orderkey, ',', o_custkey)
    WHEN 2 THEN concat(o_orderkey, ',', o_custkey, ',', o_orderstatus, ',more')
    WHEN 3 THEN concat(o_orderkey, ',x', o_custkey, ',', o_orderstatus)
    ELSE concat(o_orderkey, ',', o_custkey, ',', o_orderstatus) END"""
RESCUED_JSON = """CASE o_orderkey % 10
    WHEN 1 THEN concat('{"o_orderkey": ', o_orderkey, ', "o_custkey": ')
    WHEN 2 THEN concat('{"o_orderkey": ', o_orderkey, ', "o_custkey": [', o_custkey, ']}')
    WHEN 3 THEN concat('{"o_orderkey": ', o_orderkey, ', "o_custkey": "x', o_custkey, '"}')
    ELSE concat('{"o_orderkey": ', o_orderkey, ', "o_custkey": ', o_custkey, ', "o_orderstatus": "',
                o_orderstatus, '"}') END"""


def _rescued_sql(kind: str, line: str) -> str:
    return f"""SELECT '{kind}' AS kind, o_orderkey,
                      CASE WHEN o_orderkey % 10 NOT IN (1, 2, 3) THEN o_custkey END AS o_custkey,
                      CASE WHEN o_orderkey % 10 IN (1, 2, 3) THEN {line} END AS line,
                      CAST(NULL AS BIGINT) AS counted FROM orders
               UNION ALL SELECT '{kind}', NULL, NULL, NULL,
                      count(*) FILTER (o_orderkey % 10 IN (1, 2, 3)) FROM orders"""


@check(f"{_rescued_sql('csv', RESCUED_CSV)} UNION ALL {_rescued_sql('json', RESCUED_JSON)}")
def bronze_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that fit and lines that do not, and the latter counted over all files."""
    root = f"{workspace(spark, sf_dir, 'bronze_rescued')}/{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders")
    parts = []
    for kind, line in (("csv", RESCUED_CSV), ("json", RESCUED_JSON)):
        orders.select(F.expr(line)).write.text(f"{root}/landing/{kind}")
        source = FileSource(f"{root}/landing/{kind}", kind, rescue=True,
                            schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string")
        flow = FlowSpec("rescue", f"{root}/{kind}", "raw", "clean", "totals", source)
        run(spark, flow, ["bronze"])
        rescued = read_rescued(spark, flow)
        parts += [
            read_bronze(spark, flow).selectExpr(
                f"'{kind}' kind", "o_orderkey", "o_custkey", "CAST(NULL AS string) line",
                "CAST(NULL AS bigint) counted"),
            rescued.selectExpr(
                f"'{kind}' kind", f"CAST(regexp_extract({RESCUED}, '[0-9]+', 0) AS bigint) o_orderkey",
                "CAST(NULL AS bigint) o_custkey", f"{RESCUED} line", "CAST(NULL AS bigint) counted"),
            rescued_report(rescued).selectExpr(
                f"'{kind}' kind", "CAST(NULL AS bigint) o_orderkey", "CAST(NULL AS bigint) o_custkey",
                "CAST(NULL AS string) line", "rescued counted").groupBy(
                "kind", "o_orderkey", "o_custkey", "line").agg(F.sum("counted").alias("counted")),
        ]
    return union_all(*parts)


SPLIT_READERS = 8


@check(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS price,
              true AS evenly FROM orders"""
)
def bronze_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A read in parallel parts by quantiles of a very uneven column that also has NULLs."""
    table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS price",
        "CASE WHEN o_orderkey % 10 <> 0 THEN power(o_totalprice, 6) END AS uneven",
    ).createOrReplaceTempView("trilode_split")
    source = CatalogSource("SELECT * FROM trilode_split")
    conditions = split_predicates(spark, source, "uneven", SPLIT_READERS)
    readers = [
        spark.sql(f"{source.query} WHERE {condition}").withColumn("reader", F.lit(i))
        for i, condition in enumerate(conditions)
    ]
    rows = union_all(*readers)
    sizes = rows.groupBy("reader").count()
    evenly = sizes.agg(F.max("count") <= 2 * F.sum("count") / SPLIT_READERS).first()[0]
    return rows.select("o_orderkey", "price", F.lit(evenly).alias("evenly"))


@check("SELECT o_orderkey, o_orderstatus AS folder, true AS path FROM orders")
def bronze_source_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two forms of ``source_file``: the file of each row, and the path that was read."""
    landing = f"{workspace(spark, sf_dir, 'bronze_source_file')}/landing"
    orders = table(spark, sf_dir, "orders").withColumn("status", F.col("o_orderstatus"))
    write_table(orders, SinkSpec(landing, partition_by=["status"]))
    source = FileSource(landing, "parquet", track_file=True)
    tracked = with_lineage(read_files(spark, source), source).withColumnRenamed(SOURCE_FILE, "file")
    named = with_lineage(tracked, replace(source, track_file=False))
    return named.select(
        "o_orderkey", F.regexp_extract("file", "/status=([^/]*)/[^/]*$", 1).alias("folder"),
        (F.col(SOURCE_FILE) == landing).alias("path"))


STATUS_NAMES = [("F", "finished", 3), ("O", "open", 1), ("P", None, 2)]


@check(
    """SELECT o_orderkey, name, step FROM orders LEFT JOIN (VALUES
           ('F', 'finished', 3), ('O', 'open', 1), ('P', NULL, 2)) AS v(status, name, step)
       ON o_orderstatus = status"""
)
def bronze_inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal lookup table joined to orders."""
    names = inline_rows(spark, STATUS_NAMES, "o_orderstatus string, name string, step int")
    orders = table(spark, sf_dir, "orders")
    return orders.join(names, "o_orderstatus", "left").select("o_orderkey", "name", "step")
