"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

DataFrame functions only. Words are runs of letters, marks and digits in lower case, so that
punctuation between them does not hide a passage. A shingle is five words; an item or window of
fewer words is one shingle. Windows as long as an item are taken from a text wherever one of
the item's shingles occurs: elsewhere the similarity is zero, so none is lost. Of a run of shared
shingles only the first proposes a window, as the others propose the same one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilode.llm.common import free_name, stored

BREAK = "[^\\p{L}\\p{M}\\p{N}]+"
SHINGLE = 5
SIMILARITY = 0.8
# Bits that may differ. At similarity 0.8 some 10 of 64 do (standard deviation 3).
RADIUS = 22
# Item shingles in one broadcast table (about 40 bytes each; the index of fingerprints is smaller);
# more are searched in blocks, one pass over the documents each.
BROADCAST_ROWS = 1_000_000
_LANES = 0x0000000100000001


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), BREAK), lambda w: w != "")


def _shingles(words: str, width: Column) -> Column:
    """Arrays of ``width`` words at every position, as text (words hold no space)."""
    last = F.size(words) - width
    return F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice(words, i + 1, width), " "))


def _hashes(shingles: str) -> Column:
    return F.transform(shingles, lambda s: F.xxhash64(s))


def simhash(hashes: str) -> Column:
    """64-bit SimHash of an array of longs: a bit is set if it is set in over half of them.

    Two 32-bit counters share a long, so 32 sums give all 64 counts.
    """

    def lanes(k: int) -> Column:
        return F.aggregate(
            hashes, F.lit(0).cast("long"),
            lambda acc, h: acc + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_LANES)))

    twice = [lanes(k) for k in range(32)]
    half = F.size(hashes)
    bits = []
    for k, both in enumerate(twice):
        low = F.when(both.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > half, F.lit(1 << k))
        high = F.when(F.shiftrightunsigned(both, 32) * 2 > half,
                      F.lit((1 << (k + 32)) - ((1 << 64) if k == 31 else 0)))
        bits += [F.coalesce(low.cast("long"), F.lit(0).cast("long")),
                 F.coalesce(high.cast("long"), F.lit(0).cast("long"))]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def block_masks(radius: int) -> list[int]:
    """``radius + 1`` disjoint groups of the 64 bits, as signed longs: of two fingerprints within
    the radius at least one group is equal."""
    cuts = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _blocks(fp: str, masks: list[int]) -> Column:
    return F.posexplode(F.array(*[F.col(fp).bitwiseAND(F.lit(m)) for m in masks]))


def _common(a: str, b: str) -> Column:
    """Size of the multiset intersection of two arrays of texts."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.aggregate(
        F.array_intersect(a, b), F.lit(0),
        lambda acc, s: acc + F.least(F.size(F.filter(a, lambda x: x == s)),
                                     F.size(F.filter(b, lambda x: x == s))))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    words = benchmark.select(F.col(item_col).alias("item_id"), _words(text_col).alias("item_words"))
    sized = words.where(F.size("item_words") > 0).distinct().withColumn(
        "n", F.size("item_words")).withColumn("width", F.least(F.col("n"), F.lit(SHINGLE)))
    whole = sized.withColumn("item_shingles", _shingles("item_words", F.col("width")))
    hashed = whole.withColumn("hashes", _hashes("item_shingles"))
    numbered = hashed.withColumn("item_no", F.xxhash64("item_id", "item_shingles"))
    return numbered.withColumn("item_fp", simhash("hashes")).drop("item_words", "hashes")


def _windows(texts: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """Item-sized windows of ``texts(doc_id, text_hash, words)`` at shared shingles."""
    hashed = F.transform("item_shingles", lambda s: F.xxhash64(F.split(s, " ")))
    seeds = items.where(F.col("width") == width).select("n", hashed.alias("h")).select(
        "n", F.posexplode("h").alias("j", "seed"),
        F.concat(F.array(F.lit(None).cast("long")), "h").alias("h"),
    ).select("n", "j", "seed", F.element_at("h", F.col("j") + 1).alias("seed_before")).distinct()

    def hash_at(shift: int) -> Column:
        return F.xxhash64(*[F.get("words", F.col("pos") + (k + shift)) for k in range(width)])

    # The outer form keeps the optimizer from adding filters that split every text again.
    placed = texts.select(
        "doc_id", "text_hash", "words", F.posexplode_outer("words").alias("pos", "word"),
    ).where(F.col("pos") <= F.size("words") - width).withColumn("hash", hash_at(0))
    first = (F.col("pos") == 0) | F.col("seed_before").isNull() | (
        hash_at(-1) != F.col("seed_before"))
    hits = placed.join(F.broadcast(seeds), (F.col("hash") == F.col("seed")) & first)
    start = F.greatest(F.col("pos") - F.col("j"), F.lit(0))
    end = F.least(F.col("pos") - F.col("j") + F.col("n"), F.size("words"))
    return hits.select(
        "doc_id", "text_hash", "n", start.alias("start"),
        F.slice("words", start + 1, end - start).alias("window"))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text",
            similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, text_hash, item_id, similarity)``: the items found in each document.

    ``similarity`` is the best weighted Jaccard similarity of a window as long as the item, where
    a shingle weighs as often as it occurs. Null or blank texts and items match nothing; repeated
    rows give one result; a null id is a group of its own. Several texts under one id stay apart
    by ``text_hash``. Empty tables give no rows. Other columns are not read.
    """
    masks = block_masks(radius)
    items = stored(_items(benchmark, item_col, item_text_col), "benchmark-items")
    size = items.agg(F.sum(F.size("item_shingles")).alias("rows"),
                     F.collect_set("width").alias("widths")).first()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                        _words(text_col).alias("words"))
    parts = 1 + (size["rows"] or 0) // BROADCAST_ROWS
    found = []
    for part in range(parts):
        block = items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        for width in sorted(size["widths"]):
            windows = _windows(texts, block, width)
            marked = windows.withColumn("shingles", _shingles("window", F.lit(width))).withColumn(
                "hashes", _hashes("shingles")).withColumn("fp", simhash("hashes"))
            probes = marked.select("*", _blocks("fp", masks).alias("block", "bits"))
            index = block.where(F.col("width") == width).select(
                "item_no", "item_fp", F.col("n").alias("item_n"),
                _blocks("item_fp", masks).alias("item_block", "item_bits"))
            apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
            # A pair meets in every block that is equal; only the first of them reports it.
            equal = F.coalesce(*[
                F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
            pairs = probes.join(
                F.broadcast(index),
                (F.col("n") == F.col("item_n")) & (F.col("block") == F.col("item_block"))
                & (F.col("bits") == F.col("item_bits"))
                & (F.bit_count(apart) <= radius) & (equal == F.col("block")))
            pairs = pairs.join(
                F.broadcast(block.select(
                    F.col("item_no").alias("of_item"), "item_id", "item_shingles")),
                F.col("item_no") == F.col("of_item"))
            common = _common("shingles", "item_shingles")
            score = common / (F.size("shingles") + F.size("item_shingles") - common)
            found.append(pairs.select("doc_id", "text_hash", "item_id", score.alias("similarity"))
                         .where(F.col("similarity") >= similarity))
    if not found:
        return texts.limit(0).join(items.limit(0).select("item_id")).select(
            "doc_id", "text_hash", "item_id", F.lit(0.0).alias("similarity"))
    return reduce(DataFrame.union, found).groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("similarity").alias("similarity"))


def without_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                    text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in whose text no item was found, with all their columns."""
    hit_id, hit_hash = free_name(docs, "hit_id"), free_name(docs, "hit_hash")
    hit = matches(docs, benchmark, id_col, text_col, **options).select(
        F.col("doc_id").alias(hit_id), F.col("text_hash").alias(hit_hash)).distinct()
    return docs.join(
        hit, F.col(id_col).eqNullSafe(F.col(hit_id)) & (F.xxhash64(text_col) == F.col(hit_hash)),
        "left_anti")
