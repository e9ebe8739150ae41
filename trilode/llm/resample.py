"""Importance resampling of documents towards a target distribution.

Features are runs of words, hashed into buckets. A bucket's gain is the log ratio of its frequencies
in the target and in the documents; a document's weight is the sum over its features, looked up in
one array of gains. With Gumbel noise on the weights, the highest scores are a draw without
replacement in proportion to the weights.

How far down the draw reaches is found by weighted median-of-medians selection. Every pass takes the
median of the keys that are still in question in each partition (in chunks of ``CHUNK`` keys, so that
memory is bounded). The median of these, weighted by the sizes they stand for, has at least a quarter of
the keys on either side, so each pass discards a guaranteed share. The same pass counts both sides of
the last pivot and takes the medians of both. Only the winners are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trilode.llm.common import slices, stored

BUCKETS = 10_000
CACHE_WORDS = 500_000
# A median per so many keys and one per task come to the driver in a pass.
CHUNK = 1 << 20
# So few keys in question come to the driver themselves.
FINISH = 4096
# The keys in question are written anew when they have shrunk to a share of this.
SHRINK = 8

# Lower case for A-Z; everything in ASCII but letters and digits separates words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))
KEY = ("falling", "by_id", "row")


class _Buckets(dict):
    """Bucket of a feature, remembered within a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TABLE).split() if text else []


def features_of(words: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` consecutive words, joined by a space."""
    if longest == 1:
        return words
    runs = (words[i:i + n] for n in range(2, longest + 1) for i in range(len(words) - n + 1))
    return words + [b" ".join(run) for run in runs]


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS,
                  longest: int = 1) -> np.ndarray:
    """How many features of all rows fall into each bucket; tasks send one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in slices(batches):
            for text in batch["text"].to_pylist():
                if found := features_of(words_of(text), longest):
                    at = np.array([known[f] for f in found])
                    if len(at) > buckets // 8:
                        total += np.bincount(at, minlength=buckets)
                    else:
                        np.add.at(total, at, 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])],
                                         names=["bucket", "n"])

    texts = df.select(F.col(text_col).cast("binary").alias("text"))
    sums = texts.mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(
        F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():  # at most one row per bucket
        out[row.bucket] = row.n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio, rounded down."""
    buckets = len(raw)
    over, under = float(raw.sum() + buckets), float(target.sum() + buckets)
    return np.array([
        math.floor(1000 * math.log(((t + 1.0) * over) / ((s + 1.0) * under)))
        for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def noise(seed: str, doc_id) -> int:
    """Thousandths of a Gumbel variate that depends on the id alone; a null id counts as empty."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
           seed: str = "2024", longest: int = 1) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)`` of every row."""
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"ties are broken by an integer id, {id_col} is {kind.simpleString()}")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(len(gains))
        for batch in slices(batches):
            rows = []
            ids = batch["doc_id"].to_pylist()
            for doc_id, text in zip(ids, batch["text"].to_pylist()):
                words = words_of(text)
                found = features_of(words, longest)
                weight = int(gains[[known[f] for f in found]].sum()) if found else 0
                rows.append((len(words), len(found), weight, weight + noise(seed, doc_id)))
            columns = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *map(pa.array, columns)],
                names=["doc_id", "n_words", "n_features", "weight", "score"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                         F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(
        score, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


# ---------------------------------------------------------------- selection


def weighted_median(medians: list[tuple[int, tuple]]) -> tuple:
    """The least key such that the sizes up to it make at least half of all."""
    ordered = sorted(medians, key=lambda m: m[1])
    half = sum(n for n, _ in ordered) / 2
    return next(key for (_, key), upto in zip(ordered, accumulate(n for n, _ in ordered))
                if upto >= half)


def _literal(key: tuple):
    return F.struct(*(F.lit(int(v)).cast("bigint").alias(c) for c, v in zip(KEY, key)))


def _between(keys: DataFrame, low: tuple | None, high: tuple | None) -> DataFrame:
    """Keys after ``low`` and up to ``high``."""
    key = F.struct(*KEY)
    if low is not None:
        keys = keys.where(key > _literal(low))
    return keys if high is None else keys.where(key <= _literal(high))


def _sides(keys: DataFrame, pivot: tuple | None, chunk: int) -> tuple[list, list]:
    """``(size, median)`` per chunk of the keys up to the pivot and of those after it."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def medians(block: np.ndarray) -> list[tuple]:
            block = block[:, np.lexsort(block[::-1])]
            at = block.shape[1]
            if pivot is not None:  # how many are up to the pivot, in order of the key
                a, b, c = block
                x, y, z = pivot
                at = int(((a < x) | ((a == x) & ((b < y) | ((b == y) & (c <= z))))).sum())
            parts = ((0, block[:, :at]), (1, block[:, at:]))
            return [(side, p.shape[1], *p[:, (p.shape[1] - 1) // 2].tolist())
                    for side, p in parts if p.shape[1]]

        held, size, out = [], 0, []
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                piece = batch.slice(start, chunk)
                held.append(np.stack([piece[c].to_numpy() for c in KEY]))
                size += piece.num_rows
                if size >= chunk:
                    out += medians(np.concatenate(held, axis=1))
                    held, size = [], 0
        if held:
            out += medians(np.concatenate(held, axis=1))
        names = ["side", "n", *KEY]
        columns = np.array(out, np.int64).reshape(-1, 5).T
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    rows = keys.select(*KEY).mapInArrow(
        measure, "side bigint, n bigint, falling bigint, by_id bigint, row bigint").collect()
    found: tuple[list, list] = ([], [])
    for r in rows:
        found[r.side].append((r.n, (r.falling, r.by_id, r.row)))
    return found


def cutoff(keys: DataFrame, count: int, chunk: int = CHUNK, finish: int = FINISH) -> tuple | None:
    """The ``count``-th key in rising order of ``KEY``; None if there are fewer or ``count`` is 0.

    ``keys`` should be a stored table of distinct keys, as each pass reads it.
    """
    if count <= 0:
        return None
    low = high = None
    medians = _sides(keys, None, chunk)[0]
    size = held = sum(n for n, _ in medians)
    if count > size:
        return None
    while size > finish:
        pivot = weighted_median(medians)
        left, right = _sides(_between(keys, low, high), pivot, chunk)
        n = sum(k for k, _ in left)
        if count <= n:
            high, size, medians = pivot, n, left
        else:
            low, size, medians, count = pivot, size - n, right, count - n
        if size * SHRINK < held and size > chunk:
            keys, held = stored(_between(keys, low, high).select(*KEY), "keys-in-question"), size
    last = sorted(tuple(r) for r in _between(keys, low, high).select(*KEY).collect())
    return last[count - 1]


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` with their place in the order of ``KEY``, from a distributed sort.

    The driver sees the number of winners of each sorted partition only.
    """
    place = F.monotonically_increasing_id()  # partition in the high bits, place in it in the low 33
    done = stored(winners.orderBy(*KEY).withColumn("place", place), "winners")
    part = F.shiftright("place", 33)
    sizes = done.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes.sort(key=lambda r: r.part)
    before = accumulate(chain([0], (r.n for r in sizes)))
    offsets = done.sparkSession.createDataFrame(
        [(r.part, b) for r, b in zip(sizes, before)], "part bigint, before bigint")
    # a row per sorted partition, so small by the number of shuffle partitions
    joined = done.withColumn("part", part).join(F.broadcast(offsets), "part")
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn("rank", F.col("before") + within + 1).drop("part", "before", "place")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = 10, least_words: int = 20,
             seed: str = "2024", buckets: int = BUCKETS, longest: int = 1,
             chunk: int = CHUNK, finish: int = FINISH) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every row; ``rank`` is null if undrawn.

    Drawn are the ``percent`` highest scores, rounded down, of the rows with ``least_words`` words;
    equal scores go by the smaller id, a null id last, and rows of one id by an arbitrary but fixed
    order. A null or blank text has no features and weight 0. An empty target counts as one feature in every bucket; an
    empty table gives no rows. Every row counts, also a repeated one. Other columns are not read.
    """
    raw = bucket_counts(docs, text_col, buckets, longest)
    wanted = bucket_counts(target, target_text_col, buckets, longest)
    gains = bucket_gains(raw, wanted)
    rows = scored(docs, gains, id_col, text_col, seed, longest).select(
        "*", (-F.col("score")).alias("falling"),
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("by_id"),
        F.monotonically_increasing_id().alias("row"))
    kept = stored(rows, "scores")  # the row numbers are fixed from here on
    able = kept.where(F.col("n_words") >= least_words)
    last = cutoff(able.select(*KEY), able.count() * percent // 100, chunk, finish)
    out = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return kept.select(*out, F.lit(None).cast("bigint").alias("rank"))
    drawn = (F.col("n_words") >= least_words) & (F.struct(*KEY) <= _literal(last))
    rest = kept.where(~drawn).select(*out, F.lit(None).cast("bigint").alias("rank"))
    return ranked(kept.where(drawn)).select(*out, "rank").unionByName(rest)
