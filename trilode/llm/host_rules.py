"""Quality rules per document, and a verdict per host from its documents' failures.

DataFrame functions only. A host's failure rate for each rule is shrunk towards the rate over all
hosts by a beta prior fitted to the spread of the host rates, so that a host with few documents is
judged mostly by what hosts are like. A document is kept if it passes its own rules and no shrunk
rate of its host is above ``HOST_LIMIT``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilode.llm.common import SPACE, SPACES, stored

HOST_LIMIT = 0.5
# Strength of the prior where host rates do not spread at all.
STRONGEST = 1e6

# Each rule as a condition under which a document fails it; ``base`` is the document's own rule.
RULES = {
    "base": "n_words < 50 OR 100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 5 * n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
}


def _covered(positions: Column) -> Column:
    """Words in the three-word windows at ascending ``positions``."""
    step = F.aggregate(
        positions,
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
        lambda acc, p: F.struct(
            (acc["total"] + p + 3 - F.greatest(p, acc["end"])).alias("total"),
            (p + 3).alias("end")))
    return step["total"]


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source") -> DataFrame:
    """``doc_id, host`` and the counts the rules need, one row per input row, without a shuffle.

    ``n_repeat_words`` counts words in three-word windows that occur twice or more in the text.
    Windows are sorted, and neighbours compared, only in texts in which one repeats. Arrays that are
    used twice are columns of their own, so that none is computed again per element.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text.alias("text"),
        F.trim(text, F.lit(SPACES)).alias("trimmed"),
    ).select(
        "doc_id", "host", "text",
        F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(
            F.split("trimmed", f"{SPACE}+")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "").alias("lines"),
    )
    windows = split.select(
        "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(
            F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
            lambda w, i: F.concat_ws(" ", w, F.get("words", i + 1), F.get("words", i + 2)),
        ).alias("windows"),
    )
    ordered = windows.withColumn("ordered", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    n = F.size("ordered")
    twice = F.flatten(F.zip_with(
        F.slice("ordered", 1, n - 1), F.slice("ordered", 2, n - 1),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(
            F.array().cast("array<int>"))))
    counted = F.when(F.col("ordered").isNotNull(), _covered(F.sort_array(F.array_distinct(twice))))
    return ordered.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(counted, F.lit(0)).cast("long").alias("n_repeat_words"))


def host_rates(measured: DataFrame) -> DataFrame:
    """Per host: its documents, failures per rule and shrunk failure rates."""
    hosts = stored(measured.groupBy("host").agg(
        F.count("*").alias("docs"),
        *(F.count_if(F.expr(rule)).alias(f"{name}_failed") for name, rule in RULES.items()),
    ), "hosts")
    spread = hosts.agg(*(x for name in RULES for x in (
        (F.sum(f"{name}_failed") / F.sum("docs")).alias(f"{name}_mean"),
        F.var_pop(F.col(f"{name}_failed") / F.col("docs")).alias(f"{name}_var")))).first()
    rates = []
    for name in RULES:
        mean, var = spread[f"{name}_mean"] or 0.0, spread[f"{name}_var"] or 0.0
        strength = min(STRONGEST, mean * (1 - mean) / var - 1) if var > 0 else STRONGEST
        strength = max(strength, 0.0)
        rates.append(((F.col(f"{name}_failed") + mean * strength)
                      / (F.col("docs") + strength)).alias(f"{name}_rate"))
    return hosts.select("*", *rates)


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source") -> DataFrame:
    """The measures of every row with ``base_failed``, ``host_failed`` and ``kept``.

    A null text has no words and fails the base rule. Documents without a host are a host of their
    own. Repeated rows stay and count for their host. An empty table gives no rows. Other columns
    are not read. A text must fit into one Spark row as an array of its words.
    """
    measured = stored(measures(docs, id_col, text_col, host_col), "measures")
    bad = [F.col(f"{name}_rate") > HOST_LIMIT for name in RULES]
    hosts = host_rates(measured).select(
        F.col("host").alias("__host"), F.greatest(*[b.cast("int") for b in bad]).alias("__bad"))
    base_failed = F.expr(RULES["base"])
    host_failed = F.col("__bad") == 1
    return measured.join(hosts, F.col("host").eqNullSafe(F.col("__host"))).select(
        *measured.columns, base_failed.alias("base_failed"), host_failed.alias("host_failed"),
        (~base_failed & ~host_failed).alias("kept"))
