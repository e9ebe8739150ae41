"""Small literal tables and reproducible synthetic sales rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The sample's product and region names.
PRODUCTS = ("Laptop", "Mouse", "Keyboard", "Monitor", "Desk", "Chair", "Headphones")
REGIONS = ("North", "South", "East", "West")

FIRST_DAY = "2024-01-01"
DAYS = 91
NULL_EVERY = 50
COPY_EVERY, COPY_AT = 100, 7


def one_row(spark: SparkSession, values: Sequence, schema: str) -> DataFrame:
    """A single literal row, made in the JVM."""
    fields = zip(StructType.fromDDL(schema), values)
    columns = [F.lit(value).cast(field.dataType).alias(field.name) for field, value in fields]
    return spark.range(0, 1, 1, 1).select(*columns)


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows with a declared schema, so all-NULL columns keep their type."""
    return spark.createDataFrame(list(rows), schema)


MODULUS = 1_000_003


def _draw(row_id: Column, seed: int, draw: int, n: int) -> Column:
    """A number in [0, n) fixed by the row, the seed and the draw.

    Integer arithmetic that any SQL engine shares; operands are reduced first, so none overflows.
    """
    reduced = F.pmod(row_id.cast("long"), F.lit(MODULUS))
    mixed = (reduced * 7919 + (seed % MODULUS) * 104_729 + draw * 611_953) % MODULUS
    return ((mixed * mixed + mixed * 31 + 17) % MODULUS % n).cast("int")


def _pick(names: Sequence[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), index + 1)


def sales_rows(ids: DataFrame, seed: int = 42) -> DataFrame:
    """One sales row per value of the column ``id``, plus planted dirt.

    Each 50th id has no product and each id ending in 07 comes twice. Values depend on the id
    alone, so a recomputed partition yields the same rows.
    """
    row_id = F.col("id")
    price = (F.lit(1000) + _draw(row_id, seed, 4, 99_001)) / 100
    drawn = ids.select(
        row_id,
        F.date_add(F.lit(FIRST_DAY).cast("date"), _draw(row_id, seed, 0, DAYS))
        .cast("timestamp_ntz").alias("transaction_date"),
        F.when(row_id % NULL_EVERY != 0, _pick(PRODUCTS, _draw(row_id, seed, 1, len(PRODUCTS))))
        .alias("product"),
        _pick(REGIONS, _draw(row_id, seed, 2, len(REGIONS))).alias("region"),
        (_draw(row_id, seed, 3, 10) + 1).alias("quantity"),
        price.alias("unit_price"),
    )
    copies = F.when(row_id % COPY_EVERY == COPY_AT, 2).otherwise(1)
    return (
        drawn.withColumn("total_amount", F.round(F.col("quantity") * F.col("unit_price"), 2))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .drop("id", "copy")
    )


def sales_sample(spark: SparkSession, n: int = 1000, seed: int = 42) -> DataFrame:
    return sales_rows(spark.range(n), seed)
