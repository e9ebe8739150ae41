"""The numbered queries over the driver's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.llm import (
    decontaminate,
    host_rules,
    langid,
    licenses,
    packing,
    pii,
    quality_classifier,
    resample,
    simhash,
    token_counts,
    toxicity,
    warc,
    whitening,
)
from trilode.llm.common import crc_mod, new_folder, stored, table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, crc_mod("doc_id", 4) != 2)
    found = langid.predict(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred",
                        F.col("lang_score").alias("score"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over all documents: every document comes in; texts under five words go; counts
    are revised where an address is taken out of a text. The last batch is committed twice."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "cut", F.regexp_replace("text", r"[^\x20\x09-\x0D]+@[^\x20\x09-\x0D]+", ""))
    counts = stored(docs.select(
        "source", "lang", token_counts.rule_counts("text").alias("counts"),
        F.when(F.col("cut") != F.col("text"), token_counts.rule_counts("cut")).alias("revised"),
    ), "document-counts")
    short = F.col("counts.words-1") < 5
    gone = counts.where(short)
    changed = counts.where(~short & F.col("revised").isNotNull())
    change = token_counts.revisions(
        token_counts.by_version(changed, "counts"), token_counts.by_version(changed, "revised"))
    folder = new_folder(spark, "token-counts")
    token_counts.commit(
        token_counts.inserts(token_counts.by_version(counts, "counts")), folder, 1)
    token_counts.commit(token_counts.deletes(token_counts.by_version(gone, "counts")), folder, 2)
    for _ in range(2):
        token_counts.commit(change, folder, 3)
    return token_counts.totals(spark, folder)


OP4_SQL = r"""
WITH d AS (
    SELECT source, lang, coalesce(text, '') AS text,
        regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+@[^\x20\x09-\x0D]+', '', 'g') AS cut
    FROM documents),
k AS (SELECT * FROM d WHERE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) >= 5),
t AS (
    SELECT source, lang, 'words-1' AS tokenizer,
        len(regexp_extract_all(cut, '[^\x20\x09-\x0D]+')) AS tokens FROM k
    UNION ALL
    SELECT source, lang, 'pieces-1',
        len(regexp_extract_all(cut, '\p{L}+|\p{N}|[^\p{L}\p{N}\x20\x09-\x0D]')) FROM k)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM t GROUP BY source, lang, tokenizer
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


OP5_SQL = """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha1(coalesce(html, '')) AS payload_digest, sha256(coalesce(html, '')) AS same FROM pages),
r AS (
    SELECT same, max(page_id) AS response FROM p WHERE payload_bytes >= 1000
    GROUP BY same HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN r USING (same)
"""


def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


OP6_SQL = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
g AS (
    SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, t) AS c FROM (
        SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS t
        FROM (SELECT doc_id, w, unnest(range(len(w) - 2)) AS i FROM d))),
r AS (
    SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
    FROM g, range(3) AS x(k) WHERE c >= 2 GROUP BY doc_id),
m AS (
    SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT)
            AS n_symbols,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM d LEFT JOIN r USING (doc_id)),
f AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS f1,
        10 * n_symbols > 5 * n_words AS f2, 100 * n_dup_lines > 30 * n_lines AS f3 FROM m),
h AS (
    SELECT source, count(*) AS n, count_if(f1) AS k1, count_if(f2) AS k2, count_if(f3) AS k3
    FROM f GROUP BY source),
p AS (
    SELECT rule, sum(k) / sum(n) AS mu, var_pop(k / n) AS v FROM (
        SELECT 1 AS rule, n, k1 AS k FROM h UNION ALL SELECT 2, n, k2 FROM h
        UNION ALL SELECT 3, n, k3 FROM h) GROUP BY rule),
s AS (
    SELECT rule, mu, CASE WHEN v > 0
        THEN greatest(0, least(1e6, mu * (1 - mu) / v - 1)) ELSE 1e6 END AS strength FROM p),
b AS (
    SELECT h.source, max(CASE WHEN
        (CASE rule WHEN 1 THEN k1 WHEN 2 THEN k2 ELSE k3 END + mu * strength)
        / (n + strength) > 0.5 THEN 1 ELSE 0 END) = 1 AS bad
    FROM h, s GROUP BY h.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    f1 AS base_failed, NOT f1 AND NOT bad AS kept
FROM f JOIN b ON f.source IS NOT DISTINCT FROM b.source
"""


def _count_kind(kind: str):
    return F.size(F.filter("pii_spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def _listed(spans):
    one = F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(one, ",")


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii_spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *(_count_kind(kind).alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed("pii_spans").alias("spans"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
    held_out = F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False))
    score = F.col("toxicity")
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), score.alias("score"),
        (score >= 0.7).cast("int").alias("predicted"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "license", "containment")


# Every window of every size class, without bands.
OP9_SQL = r"""
WITH l AS (
    SELECT license, CAST(pow(2, ceil(log2(greatest(len(w), 4)))) AS BIGINT) AS c,
        list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) AS s
    FROM (SELECT license, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'),
              lambda x: x <> '') AS w
          FROM (VALUES {templates}) AS v(license, text))),
d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
        '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
p AS (
    SELECT doc_id, i, array_to_string(w[i + 1:i + 3], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(len(w) - 2)) AS i FROM d)),
q AS (SELECT license, c, len(s) AS n, unnest(s) AS g FROM l),
h AS (
    SELECT DISTINCT doc_id, license, n, g, i // c - k AS o
    FROM p JOIN q USING (g), range(2) AS x(k)
    WHERE i // c - k >= 0 AND i + 3 <= (i // c - k) * c + 2 * c)
SELECT doc_id, license, max(CAST(m AS DOUBLE) / n) AS containment
FROM (SELECT doc_id, license, n, o, count(*) AS m FROM h GROUP BY ALL)
GROUP BY doc_id, license HAVING containment >= 0.8
""".replace("{templates}", ", ".join(
    f"('{name}', '{text}')" for name, text in sorted(licenses.TEMPLATES.items())))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity")


# Every window as long as the item, at every offset from which it can share a shingle.
OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
        '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (
    SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
        '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
i AS (SELECT item_id, w, len(w) AS n, least(len(w), 5) AS k FROM b WHERE len(w) > 0),
s AS (
    SELECT item_id, n, k, g, count(*) AS c FROM (
        SELECT item_id, n, k, array_to_string(w[j + 1:j + k], ' ') AS g
        FROM (SELECT *, unnest(range(n - k + 1)) AS j FROM i)) GROUP BY ALL),
h AS (
    SELECT doc_id, item_id, pos, g, c, n, k, total FROM (
        SELECT doc_id, total, pos, k, array_to_string(w[pos + 1:pos + k], ' ') AS g FROM (
            SELECT doc_id, w, k, len(w) AS total, unnest(range(len(w) - k + 1)) AS pos
            FROM d, (SELECT DISTINCT k FROM i)))
    JOIN s USING (k, g)),
t AS (
    SELECT DISTINCT doc_id, item_id, n, k, greatest(o, 0) AS lo, least(o + n, total) AS hi
    FROM (SELECT *, unnest(range(pos - n + k, pos + 1)) AS o FROM h)),
m AS (
    SELECT doc_id, item_id, n, k, lo, hi, sum(least(x, c)) AS shared FROM (
        SELECT doc_id, item_id, t.n, t.k, lo, hi, g, c, count(*) AS x
        FROM t JOIN h USING (doc_id, item_id)
        WHERE pos >= lo AND pos + t.k <= hi GROUP BY ALL) GROUP BY ALL)
SELECT doc_id, item_id,
    max(CAST(shared AS DOUBLE) / ((hi - lo - k + 1) + (n - k + 1) - shared)) AS similarity
FROM m GROUP BY doc_id, item_id HAVING similarity >= 0.8
"""


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH RECURSIVE bits AS (
    SELECT i AS byte, i AS v, 0 AS step FROM range(256) AS r(i)
    UNION ALL
    SELECT byte, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END, step + 1
    FROM bits WHERE step < 8),
crc AS (SELECT list(v ORDER BY byte) AS t FROM bits WHERE step = 8),
lowered AS (
    SELECT 'd' AS side, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
    UNION ALL
    SELECT 't', NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (
    SELECT side, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
    FROM lowered),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM w)),
b AS (
    SELECT word, xor(4294967295, list_reduce(
        list_concat([4294967295::BIGINT], [('0x' || h[2 * i + 1:2 * i + 2])::BIGINT
            FOR i IN range(length(h) // 2)]),
        lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) % 10000 AS bucket
    FROM hexed, crc),
k AS (SELECT side, doc_id, bucket, count(*) AS n FROM w JOIN b USING (word) GROUP BY ALL),
f AS (
    SELECT bucket, sum(n) FILTER (side = 'd') AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t
    FROM k GROUP BY bucket),
a AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM f),
g AS (
    SELECT bucket, CAST(floor(1000 * ln(((f.t + 1)::DOUBLE * (a.s + 10000)::DOUBLE)
        / ((f.s + 1)::DOUBLE * (a.t + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM f, a WHERE f.s IS NOT NULL),
d AS (
    SELECT doc_id, sum(n) AS n, sum(n * gain) AS weight FROM k JOIN g USING (bucket)
    WHERE side = 'd' GROUP BY doc_id),
e AS (
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
        CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT
            + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM documents LEFT JOIN d USING (doc_id)),
r AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able
    FROM e WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= able * 10 // 100 THEN place END AS rank
FROM e LEFT JOIN r USING (doc_id)
"""


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    found = whitening.whitened(rows, whitening.fit(rows))
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = stored(quality_classifier.with_statistics(docs).drop("text"), "statistics")
    model = quality_classifier.fit(
        rows, table(spark, sf_dir, "labels"), crc_mod("doc_id", 5) != 0)
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    score = F.col("quality")
    return quality_classifier.score(rows, model).select(
        "doc_id", held_out.alias("held_out"), score.alias("score"),
        (score >= 0.3).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_packing": op2_packing,
    "op3_language_id": op3_language_id,
    "op4_token_counts": op4_token_counts,
    "op5_warc": op5_warc,
    "op6_host_quality": op6_host_quality,
    "op7_pii_spans": op7_pii_spans,
    "op8_toxicity": op8_toxicity,
    "op9_license_scan": op9_license_scan,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_quality_classifier": op13_quality_classifier,
    "pipeline": corpus_pipeline.run,
}
ORACLES: dict[str, str] = {
    "op4_token_counts": OP4_SQL,
    "op5_warc": OP5_SQL,
    "op6_host_quality": OP6_SQL,
    "op9_license_scan": OP9_SQL,
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_importance_resampling": OP11_SQL,
}
