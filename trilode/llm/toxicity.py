"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned with the trees: words and word beginnings that are far more frequent in
toxic texts, so that unseen endings of a learned stem count too. Features are densities of lexicon
hits, hits near second-person words, capitals, punctuation and obfuscation. Trees are fitted on
features from a lexicon of the other half of the sample, and calibrated on predictions for the other
half, so that neither sees its own answers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilode.llm.common import slices, stored

# Bounds of what is learned from; every text is scored.
TRAIN_DOCS = 12_000
LEXICON = 3000
LEAST_TEXTS = 4
LEAST_ODDS = 8.0
STEMS = range(4, 9)
LONGEST = 40
TREES, DEPTH, RATE, BINS = 60, 3, 0.15, 32
CACHE_WORDS = 300_000
NEAR = 4

SECOND_PERSON = frozenset("""you your yours yourself u ur du dich dir dein deine deiner euch ihr sie
    tu te toi ton ta tes vous votre vos tú ti tuyo tuya usted ustedes vosotros os""".split())
_LEET = str.maketrans("43105$@!7", "aeiossait")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[^\W\d_][^\w\s'’-]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]")
TAIL, SYMBOLS = ".,;:!?#*$%&|", "#*$%&|<>@"
_CUT = re.compile(r"[^\w]|_")
_TRIPLE = re.compile(r"(.)\1\1")


def stems(word: str) -> set[str]:
    """A word and its beginnings, in lower case and without obfuscation; the whole word ends in a
    space, so that it differs from a beginning."""
    plain = _EDGE.sub("", word).lower()
    if _INNER.search(plain):
        plain = _CUT.sub("", plain.translate(_LEET))
    if not plain or len(plain) > LONGEST:
        return set()
    return {plain + " ", *(plain[:n] for n in STEMS if n <= len(plain))}


# What each word adds: lexicon weight, hit, second person, letters, capitals, "!" and "?", symbols,
# obfuscation, threefold letters, strong hit.
WORD = 10
FEATURES = 14
# A hit is strong from this share of the lexicon's greatest weight on.
STRONG = 0.7


class Featurizer:
    """Features of whole texts, remembering what each word adds."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.heads = {s.rstrip()[:STEMS[0]] for s in lexicon}
        self.rows: dict[str, int] = {}
        self.strong = STRONG * max(lexicon.values(), default=np.inf)
        self.table = np.zeros((1 << 14, WORD))

    def _weight(self, plain: str) -> float:
        if not plain or len(plain) > LONGEST:
            return 0.0
        if plain[:STEMS[0]] not in self.heads:
            return 0.0
        get = self.lexicon.get
        return max(get(plain + " ", 0.0), *(get(plain[:n], 0.0) for n in STEMS if n <= len(plain)),
                   0.0)

    def _row(self, word: str) -> int:
        row = len(self.rows)
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        core = word.rstrip(TAIL)
        if core.isalpha():  # most words: nothing to strip or to see through
            plain, obfuscated, letters = core.lower(), False, len(core)
            bare = plain
        else:
            bare = _EDGE.sub("", word).lower()
            obfuscated, letters = bool(_INNER.search(bare)), sum(map(str.isalpha, word))
            plain = _CUT.sub("", bare.translate(_LEET)) if obfuscated else bare
        weight = self._weight(plain)
        capitals = 0 if letters < 2 or word.islower() else sum(map(str.isupper, word))
        odd = len(word) > len(core) or not core.isalpha()
        self.table[row] = (
            weight, weight > 0, bare in SECOND_PERSON, letters, capitals,
            word.count("!") + word.count("?") if odd else 0,
            sum(c in SYMBOLS for c in word) if odd else 0,
            obfuscated, bool(_TRIPLE.search(word)), weight >= self.strong)
        self.rows[word] = row
        return row

    def text(self, text: str | None) -> np.ndarray:
        words = text.split() if text else []
        if len(self.rows) > CACHE_WORDS:
            self.rows.clear()
        if not words:
            return np.zeros(FEATURES)
        get = self.rows.get
        at = np.fromiter((r if (r := get(w)) is not None else self._row(w) for w in words),
                         np.int64, len(words))
        # Every word's row stays valid: the cache is only emptied between texts.
        rows = self.table[at]
        total, n = rows.sum(axis=0), len(words)
        hits = np.flatnonzero(rows[:, 1])
        near = 0
        if len(hits):
            second = np.concatenate([[0], np.cumsum(rows[:, 2])])
            near = int((second[np.minimum(hits + NEAR + 1, n)]
                        > second[np.maximum(hits - NEAR, 0)]).sum())
        return np.array([
            total[0] / n, total[1] / n, np.log1p(total[1]), np.log1p(len(set(at[hits]))),
            near / n, total[2] / n, total[4] / max(1.0, total[3]), total[5] / n, total[6] / n,
            total[7] / n, total[8] / n, np.log1p(n), rows[:, 0].max(), np.log1p(total[9])])


class Trees(NamedTuple):
    """Complete trees in heap order over binned features."""

    edges: list[np.ndarray]
    base: float
    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, k], side="right")
                                for k, e in enumerate(self.edges)])

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned, out = self.bins(x), np.full(len(x), self.base)
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[np.arange(len(x)), feature[node]] > bound[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Second-order boosting of the logistic loss on histograms of the features."""
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1]))
             for k in range(x.shape[1])]
    mean = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    model = Trees(edges, float(np.log(mean / (1 - mean))), np.zeros((TREES, 2**DEPTH - 1), np.int64),
                  np.zeros((TREES, 2**DEPTH - 1), np.int64), np.zeros((TREES, 2**DEPTH)))
    binned, margin = model.bins(x), np.full(len(x), model.base)
    for t in range(TREES):
        p = _sigmoid(margin)
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            gain = np.full((width, x.shape[1], BINS), -np.inf)
            for k in range(x.shape[1]):
                at = (node - first) * BINS + binned[:, k]
                gs = np.bincount(at, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                hs = np.bincount(at, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                left, right = gs**2 / (hs + 1), (gs[:, -1:] - gs)**2 / (hs[:, -1:] - hs + 1)
                gain[:, k] = left + right
            best = gain.reshape(width, -1).argmax(axis=1)
            model.feature[t, first:first + width] = best // BINS
            model.bound[t, first:first + width] = best % BINS
            node = 2 * node + 1 + (
                binned[np.arange(len(x)), model.feature[t, node]] > model.bound[t, node])
        leaf = node - (2**DEPTH - 1)
        gs = np.bincount(leaf, g, 2**DEPTH)
        hs = np.bincount(leaf, h, 2**DEPTH)
        model.leaf[t] = RATE * gs / (hs + 1)
        margin += model.leaf[t, leaf]
    return model


def isotonic(x: np.ndarray, y: np.ndarray,
             weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots and values of the best non-decreasing fit of ``y`` on ``x``.

    ``weight`` says for how many rows each one stands. Each block counts half a row of either answer
    besides its own, so no value is 0 or 1.
    """
    blocks: list[list[float]] = []  # least x, greatest x, sum of y, rows
    order = np.lexsort((-y, x))  # rows with equal x are violators in this order and get one value
    weight = np.ones(len(x)) if weight is None else weight
    for a, b, w in zip(x[order], y[order], weight[order]):
        blocks.append([a, a, w * b, w])
        while len(blocks) > 1 and (blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]):
            low, high, s, n = blocks.pop()
            blocks[-1][1] = high
            blocks[-1][2] += s
            blocks[-1][3] += n
    knots = np.array([e for low, high, _, _ in blocks for e in (low, high)])
    values = np.repeat([(s + 0.5) / (n + 1) for _, _, s, n in blocks], 2)
    return knots, np.maximum.accumulate(values)


class Model(NamedTuple):
    lexicon: dict[str, float]
    trees: Trees
    knots: np.ndarray
    values: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.trees.margin(x), self.knots, self.values)


def _lexicon(rows: Iterable[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """The stems with the greatest odds from ``(stem, toxic texts, clean texts)``."""
    odds = {}
    for stem, t, c in rows:
        ratio = ((t + 0.5) / (toxic + 1)) / ((c + 0.5) / (clean + 1))
        if t >= LEAST_TEXTS and ratio >= LEAST_ODDS:
            odds[stem] = float(np.log(ratio))
    return dict(sorted(odds.items(), key=lambda x: (-x[1], x[0]))[:LEXICON])


def drawn(known: DataFrame, rows: int) -> tuple[DataFrame, dict[int, float]]:
    """About ``rows`` of ``known(label_id, y)``, up to half of them of each label and more where the
    other has fewer, chosen by a hash of the id; and for how many rows one of each label stands.

    A rare label is thus learned from all its rows as long as they fit.
    """
    toxic = F.col("y") > 0
    total = known.agg(*[F.count(F.when(toxic == bool(y), 1)).alias(f"n{y}") for y in (0, 1)]).first()
    want = [min(total[y], max(rows // 2, rows - total[1 - y])) for y in (0, 1)]
    weight = {y: total[y] / want[y] if want[y] else 1.0 for y in (0, 1)}
    below = F.when(toxic, F.lit(int((1 << 30) / weight[1]))).otherwise(
        F.lit(int((1 << 30) / weight[0])))
    return known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < below), weight


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Fit on about ``TRAIN_DOCS`` labelled rows where ``learn_from`` holds; None if there are none.

    Rows are drawn by label, and the calibration weighs them by what they stand for, so scores keep
    to the share of toxic texts among all labelled rows. Copies of a text count once, so that a text repeated many times lends its words no weight.
    """
    known = labels.where(learn_from & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    some, weight = drawn(
        known.select(F.col(id_col).alias("label_id"), F.col(label_col).alias("y")), TRAIN_DOCS)
    chosen = some.distinct().limit(2 * TRAIN_DOCS)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most 2 * TRAIN_DOCS ids and labels of 16 bytes: small by the bound of the sample.
    sample = stored(texts.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select(
        "text", F.col("y").cast("int").alias("y"),
        F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half"),
    ).where("text IS NOT NULL").dropDuplicates(["text"]), "labelled")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[str]] = {}
        for batch in slices(batches):
            counts: Counter = Counter()
            for text, y, half in zip(*(batch[c].to_pylist() for c in ("text", "y", "half"))):
                found: set[str] = set()
                for word in set(text.split()):
                    if word not in known:
                        if len(known) > CACHE_WORDS:
                            known.clear()
                        known[word] = stems(word)
                    found |= known[word]
                counts.update((s, half, y) for s in found)
            yield pa.RecordBatch.from_pydict({
                "stem": [k[0] for k in counts], "half": [k[1] for k in counts],
                "y": [k[2] for k in counts], "n": list(counts.values())},
                schema=pa.schema([("stem", pa.string()), ("half", pa.int32()), ("y", pa.int32()),
                                  ("n", pa.int64())]))

    texts = {(r.half, r.y): r.n for r in sample.groupBy("half", "y").agg(
        F.count("*").alias("n")).collect()}
    if not texts:
        return None
    # Only stems that some lexicon can take come to the driver.
    n = {(h, y): F.coalesce(F.sum(F.when((F.col("half") == h) & (F.col("y") == y), F.col("n"))),
                            F.lit(0)) for h in (0, 1) for y in (0, 1)}
    toxic = [sum(texts.get((h, y), 0) for h in (0, 1)) for y in (0, 1)]
    worth = (F.col("t0") + F.col("t1") >= LEAST_TEXTS) & (
        (F.col("t0") + F.col("t1") + 0.5) / (toxic[1] + 1)
        >= LEAST_ODDS / 4 * (F.col("c0") + F.col("c1") + 0.5) / (toxic[0] + 1))
    rows = sample.mapInArrow(tally, "stem string, half int, y int, n bigint").groupBy("stem").agg(
        n[0, 1].alias("t0"), n[0, 0].alias("c0"), n[1, 1].alias("t1"), n[1, 0].alias("c1"),
    ).where(worth).orderBy(F.desc(F.col("t0") + F.col("t1")), "stem").limit(20 * LEXICON).collect()
    lexicons = [
        _lexicon(((r.stem, r[f"t{h}"], r[f"c{h}"]) for r in rows),
                 texts.get((h, 1), 0), texts.get((h, 0), 0)) for h in (0, 1)]
    whole = _lexicon(((r.stem, r.t0 + r.t1, r.c0 + r.c1) for r in rows), toxic[1], toxic[0])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        makers = [Featurizer(lexicon) for lexicon in lexicons]
        for batch in slices(batches):
            x = [makers[1 - h].text(t).tolist() for t, h in zip(
                batch["text"].to_pylist(), batch["half"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.list_(pa.float64())), batch["y"], batch["half"]],
                names=["x", "y", "half"])

    got = sample.mapInArrow(measure, "x array<double>, y int, half int").orderBy("x", "y").toArrow()
    x = np.array(got["x"].to_pylist(), float).reshape(-1, FEATURES)
    y = (got["y"].to_numpy() > 0).astype(float)
    half = got["half"].to_numpy()
    margin = np.zeros(len(y))
    for h in (0, 1):
        other = half != h if (half != h).any() else half == h
        margin[half == h] = boost(x[other], y[other]).margin(x[half == h])
    return Model(whole, boost(x, y), *isotonic(margin, y, np.where(y > 0, weight[1], weight[0])))


def score(docs: DataFrame, model: Model | None, text_col: str = "text",
          score_col: str = "toxicity") -> DataFrame:
    """``docs`` with a calibrated score from 0 to 1.

    A null or blank text is scored like any other, from features that are all zero; without a model
    (no labelled rows) every score is 0. Other columns pass through, and one with the name of the
    new one is replaced.
    """
    rest = docs.drop(score_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Featurizer(model.lexicon if model else {})
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            x = np.array([maker.text(t) for t in texts]).reshape(-1, FEATURES)
            found = model.scores(x) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())],
                names=[*batch.schema.names, score_col])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(add, f"{columns}, `{score_col}` double")
