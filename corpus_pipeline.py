"""From raw documents to packed sequences: five stages, each handing a table to the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows it is given. All but the last
return the columns of ``documents``. Nulls, empty tables, repeated rows and extra columns are
handled as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.llm import decontaminate, langid, packing, pii, simhash
from trilode.llm.common import free_name, stored, table

# A text is rejected when its best language explains it a million times worse than the background
# model does; clean texts of a single rare word stay above.
LEAST_SCORE = 1e-6


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts of no known language; where ``lang`` is null the prediction fills it."""
    model = langid.fit(docs, F.lit(True))
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = langid.predict(docs, model, lang_col=lang, score_col=score)
    kept = found.where((F.col(lang) != langid.UND) & (F.col(score) >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", lang)).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least id of each near-duplicate group."""
    return simhash.keep_one(docs).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain a benchmark item."""
    return decontaminate.without_matches(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by marks such as ``[EMAIL]``; ``n_chars`` follows the text."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]

# Fingerprints, trained models and tokenizers are beyond SQL; tests hold each stage against brute
# force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
