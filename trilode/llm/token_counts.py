"""Token totals by source, language and tokenizer version, kept up by signed deltas.

An insert adds a document's count, a delete takes it away, and a revised count does both. A batch
of changes is summed per group before it is stored, so the store grows with batches and groups and
not with documents, and totals are sums over it. A batch is stored under its id and replaces
what a first, possibly broken, attempt left: committing it again changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.llm.common import slices
from trilode.llm.packing import Encoder

GROUP = ("source", "lang", "tokenizer")

# Counting rules that need no vocabulary: words between white space; runs of letters, single digits
# and single other characters.
RULES = {
    "words-1": r"[^\x20\x09-\x0D]+",
    "pieces-1": r"\p{L}+|\p{N}|[^\p{L}\p{N}\x20\x09-\x0D]",
}


def rule_count(text: str, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(pattern)).cast("long")


def rule_counts(text: str, rules: dict[str, str] = RULES) -> Column:
    """A struct with a count per rule; a null text has no tokens."""
    return F.struct(*[rule_count(text, p).alias(v) for v, p in rules.items()])


def by_version(docs: DataFrame, counts: str, rules: dict[str, str] = RULES) -> DataFrame:
    """One row per document and rule: ``source, lang, tokenizer, tokens``, from a struct column."""
    pairs = F.array(*[F.struct(F.lit(v).alias("tokenizer"),
                               F.col(counts).getField(v).alias("tokens")) for v in rules])
    return docs.select("source", "lang", F.inline(pairs))


def vocabulary_counts(docs: DataFrame, version: str, path: str | None = None,
                      text_col: str = "text") -> DataFrame:
    """``source, lang, tokenizer, tokens`` by a public tokenizer file, encoded in Arrow batches."""
    narrow = docs.select("source", "lang", F.col(text_col).cast("binary").alias("text"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in slices(batches):
            n = [len(ids) // 4 for ids in encoder.batch(batch["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch["source"], batch["lang"], pa.array([version] * len(n), pa.string()),
                 pa.array(n, pa.int64())], names=["source", "lang", "tokenizer", "tokens"])

    kinds = {f.name: f.dataType.simpleString() for f in narrow.schema}
    return narrow.mapInArrow(add, f"source {kinds['source']}, lang {kinds['lang']}, "
                                  "tokenizer string, tokens bigint")


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, F.lit(1).alias("sign"), "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, F.lit(-1).alias("sign"), "tokens")


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """The change from ``old`` to ``new`` counts; their source, language or version may differ."""
    return deletes(old).unionByName(inserts(new))


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums per group, combined before the shuffle; groups that come to nothing are left out.

    A null count adds a document and no tokens; nulls in a group column are a group.
    """
    return changes.groupBy(*GROUP).agg(
        F.sum(F.col("sign").cast("long")).alias("docs"),
        F.coalesce(F.sum(F.col("sign") * F.col("tokens")), F.lit(0)).alias("tokens"),
    ).where("docs <> 0 OR tokens <> 0")


def commit(changes: DataFrame, folder: str, batch_id: int) -> None:
    """Store a batch. A batch's changes are fixed: the same id means the same changes.

    Fits ``foreachBatch``, whose batch ids and rows come again unchanged after a failure.
    """
    (deltas(changes).withColumn("batch", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(folder))


def totals(spark: SparkSession, folder: str) -> DataFrame:
    """``source, lang, tokenizer, docs, tokens`` over all committed batches; without any, no rows."""
    schema = "source string, lang string, tokenizer string, docs bigint, tokens bigint, batch bigint"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema).drop("batch")
    return spark.read.schema(schema).parquet(folder).groupBy(*GROUP).agg(
        F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"),
    ).where("docs <> 0 OR tokens <> 0")
