"""License notices in documents: MinHash bands of overlapping windows, then exact containment.

DataFrame functions only. Words are runs of letters and digits in lower case, and a shingle is
``SHINGLE`` of them. The size class of a template is the least power of two that holds its words;
windows of a class are twice as long and start every class size, so that a notice lies whole in
one of them. At a containment of 0.8 a window and its template then have a Jaccard similarity of
at least about 0.17, so that with ``BANDS`` bands of one row they share a band with a probability of
at least 0.999. A verbatim notice of one shingle, which is one of six of its window, has no more.

A window has a template's value in a band only if it holds the shingle that gives the template this
value. Windows are therefore built only around such shingles, which leaves out none that would
have been retrieved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trilode.llm.common import stored

# Notices by which texts name their license.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may "
    "not use this file except in compliance with the License. You may obtain a copy of the License "
    "at http://www.apache.org/licenses/LICENSE-2.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-header": "This program is free software: you can redistribute it and/or modify it under "
    "the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit": "Released under the MIT License.",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy "
    "of this software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction",
}
BREAK = "[^\\p{L}\\p{N}]+"
SHINGLE = 3
CONTAINMENT = 0.8
BANDS = 40
LEAST_CLASS = 4


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), BREAK), lambda w: w != "")


def _shingles(words: str) -> Column:
    last = F.size(words) - SHINGLE
    return F.array_distinct(F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice(words, i + 1, SHINGLE), " ")))


def _hashes(shingles: str) -> Column:
    return F.transform(shingles, lambda s: F.xxhash64(F.split(s, " ")))


def signature(hashes: str) -> Column:
    """MinHash values of an array of shingle hashes, one per band; nulls for an empty array."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*[least(band) for band in range(BANDS)])


def _giver(hashes: str, band: int) -> Column:
    """The shingle hash that gives an array its MinHash value in a band."""
    return F.array_min(F.transform(hashes, lambda h: F.struct(
        F.xxhash64(h, F.lit(band)).alias("value"), h.alias("hash"))))["hash"]


def template_table(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """``license, class, template`` (its shingles) and ``hashes``; notices under three words have
    no shingle and cannot be found."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    words = rows.select("license", _words("text").alias("words"))
    size = F.greatest(F.size("words"), F.lit(LEAST_CLASS))
    return words.select(
        "license", F.pow(F.lit(2), F.ceil(F.log2(size))).cast("int").alias("class"),
        _shingles("words").alias("template"),
    ).where(F.size("template") > 0).withColumn("hashes", _hashes("template"))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id",
         text_col: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """``(doc_id, text_hash, license, containment)``: the notices found in each document.

    ``containment`` is the greatest share of the notice's shingles in one window. Null and blank
    texts match nothing; repeated rows give one result, and texts under one id (or none) stay apart
    by ``text_hash``. Empty tables give no rows. Other columns are not read.
    """
    known = stored(template_table(docs.sparkSession, templates), "license-templates")
    # The templates are a parameter: at most BANDS shingles and bands each, so broadcasting is safe.
    bands = known.withColumn("values", signature("hashes")).select(
        "license", F.col("class").alias("of_class"), "template",
        F.posexplode("values").alias("of_band", "of_value"))
    # The shingles that give a template its band values: where windows are worth building.
    sketch = known.select("class", F.explode(F.array(*[
        _giver("hashes", band) for band in range(BANDS)])).alias("of_hash")).distinct()

    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        _words(text_col).alias("words"))
    placed = texts.select(
        "doc_id", "text_hash", "words", F.posexplode_outer("words").alias("pos", "word"),
    ).where(F.col("pos") <= F.size("words") - SHINGLE).withColumn(
        "hash", F.xxhash64(*[F.get("words", F.col("pos") + k) for k in range(SHINGLE)]))
    hits = placed.join(F.broadcast(sketch), F.col("hash") == F.col("of_hash"))
    at = F.floor(F.col("pos") / F.col("class")).cast("int")
    around = hits.select(
        "doc_id", "text_hash", "class", "words",
        F.explode(F.array(at, at - 1)).alias("window")).where("window >= 0")
    windows = around.select(
        "doc_id", "text_hash", "class", "window",
        F.slice("words", F.col("window") * F.col("class") + 1, 2 * F.col("class")).alias("part"),
    ).groupBy("doc_id", "text_hash", "class", "window").agg(F.first("part").alias("part"))
    marked = windows.select("*", _shingles("part").alias("shingles")).withColumn(
        "hashes", _hashes("shingles")).withColumn("values", signature("hashes"))
    probes = marked.select("doc_id", "text_hash", "class", "shingles",
                           F.posexplode("values").alias("band", "value"))
    found = probes.join(F.broadcast(bands), (F.col("class") == F.col("of_class"))
                        & (F.col("band") == F.col("of_band"))
                        & (F.col("value") == F.col("of_value")))
    share = F.size(F.array_intersect("shingles", "template")) / F.size("template")
    return found.select("doc_id", "text_hash", "license", share.alias("containment")).where(
        F.col("containment") >= containment).groupBy("doc_id", "text_hash", "license").agg(
        F.max("containment").alias("containment"))
