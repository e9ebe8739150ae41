"""Text quality from document statistics: random Fourier features, ridge scores, isotonic calibration.

Each text becomes a short vector of statistics. Random Fourier features of the standardised vector
have inner products that approximate a Gaussian kernel. The ridge fit on them needs only their normal
equations, which every partition sums for itself, so that all labelled rows count. Rows are split in
two halves by a hash of their statistics; the fit on one half scores the other, and these
scores are calibrated by isotonic regression. The scoring model is the fit on both halves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trilode.llm.common import slices, stored
from trilode.llm.sums import matrix_sum

WAVES = 512
SEED = 20_24
# Width of the kernel for standardised statistics, by the square root of their number.
WIDTH = 1.5
# Standardised statistics end here, so that one odd text is not far from everything.
FARTHEST = 4.0
RIDGE = 0.01
# Calibration sees raw scores in cells of this width.
CELL = 1 / 1024

_ALL = bytes(range(256))
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>@^~=+_{}[]\\/"
_STOPS = b".,;:"
_CALLS = b"!?"
_SPACES = b" \t\n\x0b\x0c\r"
NAMES = (
    "words", "word_length", "symbols", "symbol_ends", "capitals", "all_capitals", "digits", "stops",
    "calls", "call_ends", "high_bytes", "kinds_of_words", "top_word", "repeated_pairs",
    "repeated_lines", "line_words", "lone_marks", "long_words", "echoes")


def statistics(text: bytes | None) -> list[float]:
    """Statistics of a whole text, all 0 for a null or blank one.

    A word is ``[^\\x20\\x09-\\x0D]+``. Rates are by word or by byte, so that they do not grow with
    the text; counts are logarithms.
    """
    words = text.split() if text else []
    if not words:
        return [0.0] * len(NAMES)
    n = len(words)
    size = len(text) - sum(text.count(c) for c in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r"))

    def rate(marks: bytes) -> int:
        return len(text) - len(text.translate(None, marks))

    upper, lower = rate(_UPPER), rate(_LOWER)
    ends = Counter([w[-1] for w in words])
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    lengths = np.fromiter(map(len, words), np.int64, n)
    capital = sum(k for w, k in counts.items() if w.isupper())
    lone = sum(k for w, k in counts.items() if len(w) == 1 and not w.isalnum() and w < b"\x80")
    return [
        np.log1p(n), np.log1p(size / n), np.sqrt(rate(_SYMBOLS) / n),
        np.sqrt(sum(ends[c] for c in _SYMBOLS) / n), upper / max(1, upper + lower), capital / n,
        np.sqrt(rate(_DIGITS) / size), np.sqrt(rate(_STOPS) / n), np.sqrt(rate(_CALLS) / n),
        np.sqrt(sum(ends[c] for c in _CALLS) / n), 1 - len(text.translate(None, _ALL[128:])) / len(text),
        np.log1p(len(counts)) / np.log1p(n), max(counts.values()) / n,
        1 - pairs / (n - 1) if n > 1 else 0.0, 1 - len(set(lines)) / len(lines),
        np.log1p(n / len(lines)), lone / n, float((lengths > 25).mean()),
        np.sqrt(sum(map(eq, words, words[1:])) / n)]


def with_statistics(docs: DataFrame, text_col: str = "text", out: str = "statistics") -> DataFrame:
    """``docs`` with the statistics of each text as an array; a column of that name is replaced."""
    rest = docs.drop(out)
    at = rest.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            found = pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, found],
                                             names=[*batch.schema.names, out])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(add, f"{columns}, `{out}` array<double>")


class Waves(NamedTuple):
    """Standardisation and random Fourier features, with a constant in front."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    phases: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        plain = np.clip((x - self.mean) / self.scale, -FARTHEST, FARTHEST)
        waves = np.cos(plain @ self.weights + self.phases)
        return np.column_stack([np.ones(len(x)), waves * np.sqrt(2 / len(self.phases))])


def waves(mean: np.ndarray, scale: np.ndarray, count: int = WAVES, seed: int = SEED,
          width: float = WIDTH) -> Waves:
    """Features whose products approximate ``exp(-|a - b|^2 / (2 w^2))`` for standardised vectors,
    ``w`` being ``width`` times the square root of their length."""
    draw = np.random.default_rng(seed)
    d = len(mean)
    return Waves(mean, scale, draw.standard_normal((d, count)) / (width * np.sqrt(d)),
                 draw.uniform(0, 2 * np.pi, count))


def ridge(gram: np.ndarray, right: np.ndarray, penalty: float = RIDGE) -> np.ndarray:
    """Weights of the ridge fit from its normal equations; the constant is not shrunk."""
    shrink = np.full(len(gram), penalty)
    shrink[0] = 1e-9
    return np.linalg.solve(gram + np.diag(shrink), right)


def pooled(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Isotonic regression: the non-decreasing means closest to ``values``, weighted by ``counts``."""
    blocks: list[list[float]] = []  # mean, weight, cells
    for value, count in zip(values, counts):
        blocks.append([float(value), float(count), 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            value, count, cells = blocks.pop()
            last = blocks[-1]
            last[0] = (last[0] * last[1] + value * count) / (last[1] + count)
            last[1] += count
            last[2] += cells
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


class Model(NamedTuple):
    waves: Waves
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.waves.of(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.values)


def _vectors(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch[column].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def fit(rows: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id",
        label_col: str = "quality", statistics_col: str = "statistics") -> Model | None:
    """Fit on all labelled rows where ``learn_from`` holds; None if there are none.

    ``rows`` come from :func:`with_statistics`. ``learn_from`` is about columns of ``labels``. Null
    ids and labels teach nothing. Texts with equal statistics count once, with their mean label, so
    that copies lend no weight.
    """
    known = labels.where(learn_from).where(
        F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
    vectors = rows.select(F.col(id_col).alias("id"), F.col(statistics_col).alias("x"))
    taught = stored(vectors.join(known, "id").groupBy("x").agg(F.avg("y").alias("y")).select(
        "x", "y", F.pmod(F.xxhash64("x"), F.lit(2)).cast("int").alias("half")), "taught")
    d = len(NAMES)

    def moments(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        found = np.zeros((3, d))
        for batch in batches:
            x = _vectors(batch, "x")
            found += [x.sum(axis=0), (x**2).sum(axis=0), np.full(d, len(x))]
        return found

    sums = matrix_sum(taught, moments, (3, d))
    n = sums[2, 0]
    if not n:
        return None
    mean = sums[0] / n
    spread = np.sqrt(np.maximum(sums[1] / n - mean**2, 0))
    maker = waves(mean, np.where(spread > 1e-6, spread, 1.0))
    size = WAVES + 1

    def normal(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        found = np.zeros((2, size, size + 1))
        for batch in slices(batches, 4096):
            z, half = maker.of(_vectors(batch, "x")), batch["half"].to_numpy()
            with_y = np.column_stack([z, batch["y"].to_numpy()])
            for h in (0, 1):
                found[h] += z[half == h].T @ with_y[half == h]
        return found.reshape(2 * size, size + 1)

    both = matrix_sum(taught, normal, (2 * size, size + 1)).reshape(2, size, size + 1)
    whole = both.sum(axis=0)
    # the fit for a half is the one on the other half, unless that is empty
    other = [ridge(m[:, :size], m[:, size])
             for m in (both[1 - h] if both[1 - h].any() else whole for h in (0, 1))]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            z, half = maker.of(_vectors(batch, "x")), batch["half"].to_numpy()
            raw = np.where(half == 0, z @ other[0], z @ other[1])
            cell = np.floor(np.clip(raw, -1, 2) / CELL).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch["y"]], names=["cell", "y"])

    # at most one row per cell
    cells = taught.mapInArrow(place, "cell bigint, y double").groupBy("cell").agg(
        F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")).collect()
    cells.sort(key=lambda r: r.cell)
    counts = np.array([r.n for r in cells], float)
    # half a row of either answer besides, so that no value is 0 or 1
    prior = np.array([(r.y + 0.5) / (r.n + 1) for r in cells])
    knots = (np.array([r.cell for r in cells]) + 0.5) * CELL
    return Model(maker, ridge(whole[:, :size], whole[:, size]), knots, pooled(prior, counts))


def score(rows: DataFrame, model: Model | None, statistics_col: str = "statistics",
          score_col: str = "quality") -> DataFrame:
    """``rows`` with a calibrated score from 0 to 1; a column of that name is replaced.

    Null and blank texts are scored like any other, from statistics that are all 0. Without a model
    (no labelled rows) every score is 0.5. Other columns pass through.
    """
    rest = rows.drop(score_col)
    at = rest.columns.index(statistics_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            x = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))
            found = model.scores(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())],
                                             names=[*batch.schema.names, score_col])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return rest.mapInArrow(add, f"{columns}, `{score_col}` double")
