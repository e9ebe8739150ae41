"""SimHash near-duplicates: fingerprints, vantage-point shards, exact links, components.

A pair within ``radius`` bits is within ``radius // blocks`` bits in at least one of ``blocks``
disjoint groups of bits. One vantage-point tree per bit group partitions the distinct
fingerprints by Hamming distance over that group; the small radius there keeps the band around
each threshold narrow, so few fingerprints visit a leaf besides their own. A leaf is a shard, and
candidates in a shard are compared over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilode.llm.common import free_name, slices, stored
from trilode.llm.components import components

SEED = 42
CHUNK = 1 << 15
# Distinct fingerprints a shard should hold, and the most levels of the distributed tree.
SHARD = 1024
MAX_DEPTH = 14
# Vantage points tried for a split.
TRIALS = 8

_digest = partial(xxhash.xxh64_intdigest, seed=SEED)


def _fingerprint(text: bytes | None, width: int) -> int:
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < width:
        shingles, total = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(width))))
        total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    while len(part := np.fromiter(map(_digest, islice(shingles, CHUNK)), np.uint64)):
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = 4) -> DataFrame:
    """``(doc_id, text_hash, fp)``, one row per input row; a text without words has ``fp`` 0.

    ``fp`` is the 64-bit SimHash of the ``width``-word shingles as a signed long.
    """
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).cast("binary").alias("text"),
    )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.fromiter((_fingerprint(t.as_py(), width) for t in batch["text"]),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(fps.view(np.int64))],
                names=["doc_id", "text_hash", "fp"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(add, f"doc_id {kind}, text_hash bigint, fp bigint")


class Tree(NamedTuple):
    """A complete vantage-point tree over the bits of ``mask``, in heap order."""

    mask: int
    radius: int
    depth: int
    vantage: np.ndarray
    bound: np.ndarray

    def _distance(self, fps: np.ndarray, node: np.ndarray) -> np.ndarray:
        return np.bitwise_count((fps ^ self.vantage[node]) & np.uint64(self.mask)).astype(np.int16)

    def home(self, fps: np.ndarray) -> np.ndarray:
        node = np.zeros(len(fps), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (self._distance(fps, node) > self.bound[node])
        return node - (2**self.depth - 1)

    def visits(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaves that may hold a point within the radius: a branch is left out
        only where the triangle inequality rules it out."""
        row, node = np.arange(len(fps)), np.zeros(len(fps), np.int64)
        for _ in range(self.depth):
            d, bound = self._distance(fps[row], node), self.bound[node]
            low, high = d - self.radius <= bound, d + self.radius > bound
            row, node = (np.concatenate([row[low], row[high]]),
                         np.concatenate([2 * node[low] + 1, 2 * node[high] + 2]))
        return row, node - (2**self.depth - 1)


def _split(points: np.ndarray, mask: np.uint64, rng: np.random.Generator):
    """A vantage point and bound that halve ``points`` well; None if all distances are equal."""
    best = None
    for vantage in rng.choice(points, min(TRIALS, len(points)), replace=False):
        d = np.bitwise_count((points ^ vantage) & mask)
        bound = int(np.median(d))
        for bound in (bound - 1, bound):
            right = int((d > bound).sum())
            skew = abs(2 * right - len(points))
            if 0 < right < len(points) and (best is None or skew < best[0]):
                best = skew, vantage, bound
    return best and best[1:]


def fit_tree(sample: np.ndarray, mask: int, radius: int, depth: int, seed: int = 0) -> Tree:
    rng = np.random.default_rng(seed)
    size = 2**depth - 1
    vantage, bound = np.zeros(size, np.uint64), np.zeros(size, np.int16)
    parts = {0: sample}
    for node in range(size):
        points = parts.pop(node, sample[:0])
        found = _split(points, np.uint64(mask), rng) if len(points) > 1 else None
        # Without a split every point goes left: no point is within the radius beyond 64 + radius.
        vantage[node], bound[node] = found or (0, 64 + radius)
        right = np.bitwise_count((points ^ vantage[node]) & np.uint64(mask)) > bound[node]
        parts[2 * node + 1], parts[2 * node + 2] = points[~right], points[right]
    return Tree(mask, radius, depth, vantage, bound)


class _Links:
    """Local components of the links seen so far, by index."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while len(a):
            la, lb = label[a], label[b]
            low = np.minimum(la, lb)
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while (label[label] != label).any():
                label[:] = label[label]
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]


def _search(fps, home, visit, mask, radius, block_radius, links, rng) -> None:
    """Link home with home and home with visitor, all given as indices into ``fps``."""
    if len(home) > SHARD and (found := _split(fps[home], mask, rng)):
        vantage, bound = found
        dh = np.bitwise_count((fps[home] ^ vantage) & mask).astype(np.int16)
        dv = np.bitwise_count((fps[visit] ^ vantage) & mask).astype(np.int16)
        left = dh <= bound
        crossing = home[left & (dh + block_radius > bound)]
        _search(fps, home[left], visit[dv - block_radius <= bound],
                mask, radius, block_radius, links, rng)
        _search(fps, home[~left], np.concatenate([visit[dv + block_radius > bound], crossing]),
                mask, radius, block_radius, links, rng)
        return
    both = np.concatenate([home, visit])
    step = max(1, (1 << 21) // max(1, len(both)))
    for i in range(0, len(home), step):
        rows, rest = home[i:i + step], both[i:]
        near = np.bitwise_count(fps[rows][:, None] ^ fps[rest][None, :]) <= radius
        a, b = np.nonzero(near)
        keep = a < b
        links.add(rows[a[keep]], rest[b[keep]])


def links(classes: DataFrame, radius: int = 4, blocks: int = 3) -> DataFrame:
    """Links ``(a, b)`` that connect all fingerprints of ``classes(fp)`` within ``radius`` bits.

    Per shard it returns a spanning star per local component and not all pairs, so a dense group
    of n fingerprints costs at most n rows. The trees are fitted on a bounded sample (16
    fingerprints per leaf, at most 2^18); every fingerprint is placed and searched.
    """
    total = classes.count()
    depth = min(MAX_DEPTH, max(0, (total // SHARD).bit_length()))
    sample = classes.orderBy(F.xxhash64("fp")).limit(16 << depth).toPandas()["fp"]
    sample = sample.to_numpy(np.int64).view(np.uint64)
    cuts = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    trees = [fit_tree(sample, m, radius // blocks, depth, seed=i) for i, m in enumerate(masks)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for i, tree in enumerate(trees):
                home = tree.home(fps)
                row, leaf = tree.visits(fps)
                keep = leaf >= home[row]  # the lower leaf visits the higher
                row, leaf = row[keep], leaf[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((i << depth) + leaf), pa.array(fps[row].view(np.int64)),
                     pa.array(leaf == home[row])],
                    names=["shard", "fp", "home"])

    def search(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        tree = trees[key[0] >> depth]
        fps = shard["fp"].to_numpy(np.int64).view(np.uint64)
        home = shard["home"].to_numpy(bool)
        found = _Links(len(fps))
        _search(fps, np.nonzero(home)[0], np.nonzero(~home)[0], np.uint64(tree.mask), radius,
                tree.radius, found, np.random.default_rng(key[0]))
        far = np.nonzero(found.label != np.arange(len(fps)))[0]
        signed = fps.view(np.int64)
        return pd.DataFrame({"a": signed[far], "b": signed[found.label[far]]})

    placed = classes.select("fp").mapInArrow(place, "shard bigint, fp bigint, home boolean")
    return placed.groupBy("shard").applyInPandas(search, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 4, radius: int = 4, blocks: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp, component_id, component_text_hash)``, one row per input row.

    ``component_id`` is the least id reachable over links of at most ``radius`` differing bits,
    itself included; rows with null ids take part and a component without any id has a null one.
    ``component_text_hash`` tells which text of that id represents the component. Null, empty and
    blank texts share fingerprint 0. An empty table gives an empty table. Other columns of
    ``docs`` are not read.
    """
    fps = stored(fingerprints(docs, id_col, text_col, width), "fingerprints")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = stored(fps.groupBy("fp").agg(F.min(first).alias("first")), "fingerprint-classes")
    nodes = components(links(classes, radius, blocks))
    linked = nodes.join(classes, nodes.node == classes.fp).select("node", "root", "first")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    reach = linked.select("node", "root").join(least, "root").select("node", "least")
    # Written, so that both sides of the last join come straight from a scan and a fingerprint that
    # very many documents share can be split.
    placed = stored(classes.join(reach, classes.fp == reach.node, "left").select(
        "fp", F.coalesce("least", "first").alias("least")), "fingerprint-components")
    return fps.join(placed, "fp").select(
        "doc_id", "text_hash", "fp",
        F.col("least.doc_id").alias("component_id"),
        F.col("least.text_hash").alias("component_text_hash"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             **options) -> DataFrame:
    """One row of each near-duplicate group with all its columns: the one with the least id.

    Whole rows are shuffled once: repeated rows go first, within each task and then by the key of
    the join. The id is in a struct there, since a null one has to meet a null one.
    """
    key, text_hash, best_key, best_hash = (
        free_name(docs, n) for n in ("id_key", "text_hash", "best_key", "best_hash"))
    best = near_duplicates(docs, id_col, text_col, **options).select(
        F.struct(F.col("component_id").alias("id")).alias(best_key),
        F.col("component_text_hash").alias(best_hash),
    ).distinct()
    keyed = docs.withColumns({
        key: F.struct(F.col(id_col).alias("id")), text_hash: F.xxhash64(text_col)})
    same = (F.col(key) == F.col(best_key)) & (F.col(text_hash) == F.col(best_hash))
    return keyed.dropDuplicates([key, text_hash]).join(best, same, "left_semi").drop(key, text_hash)


def hex_digits(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
