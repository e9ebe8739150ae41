"""Whitening of embeddings by shifted CholeskyQR.

Vectors become whole numbers, whose sums are exact, and are centred before anything is multiplied.
Each distributed Gram pass gives one triangular factor; rows go through the triangular solves of all
factors so far, which makes them orthonormal up to rounding after the third pass even where the
first Gram matrix was too ill-conditioned to be factored without a shift. The product of the factors
is the R of the centred rows, and its singular values and right vectors are those of the rows: the
covariance matrix itself, whose condition is the square, is never decomposed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trilode.llm.common import slices
from trilode.llm.sums import matrix_sum

SCALE, SHIFT, LIMIT = 1024, 100_000, 1 << 50
COMPONENTS = 8
PASSES = 3
MORE_PASSES = 6
SOLVE_ROWS = 4096


def _fine(df: DataFrame, vector_col: str) -> DataFrame:
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return df.where(vector.isNotNull() & (F.size(vector) > 0)).where(finite)


def dimensions(df: DataFrame, vector_col: str = "embedding") -> int | None:
    """The most frequent length of the vectors with only finite entries; of equally frequent ones
    the greatest. Vectors of another length lie in no common space and are left out like null ones.
    """
    sizes = _fine(df, vector_col).groupBy(F.size(vector_col).alias("n")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    return first.n if first else None


def usable(df: DataFrame, d: int, vector_col: str = "embedding") -> DataFrame:
    """Rows with a vector of ``d`` finite entries."""
    return _fine(df, vector_col).where(F.size(vector_col) == d)


def whole(column: pa.Array, d: int) -> np.ndarray:
    """Vectors as whole numbers, one per line."""
    entries = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(float))
    if len(entries) and abs(entries).max() >= LIMIT:
        raise ValueError(f"an entry is beyond {LIMIT / SCALE:.3g}, which is not whole any more")
    return (entries.astype(np.int64) + SHIFT).reshape(-1, d)


class Centre(NamedTuple):
    """Number of vectors, exact sums of each dimension and the greatest absolute entry."""

    n: int
    sums: list[int]
    greatest: int

    def spread(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums`` exactly, in Python integers where 64 bits might not hold it."""
        if 2 * self.n * max(1, self.greatest) < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.spread(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of squares of the spread, exactly."""
        spread = self.spread(x)
        most = 2 * self.n * max(1, self.greatest)
        if most * most * len(self.sums) >= 1 << 62:  # unless this batch happens to be closer
            most = int(abs(spread).max()) if spread.size else 0
        if most * most * len(self.sums) < 1 << 62:
            total = (spread.astype(np.int64) ** 2).sum(axis=1)
            return pa.array(total, pa.int64()).cast(pa.decimal128(38, 0))
        total = (spread.astype(object) ** 2).sum(axis=1)
        return pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))


class Model(NamedTuple):
    centre: Centre
    values: np.ndarray  # variances, falling
    vectors: np.ndarray  # a unit component per column
    explained: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; a component without variance is 0."""
        some = self.values > 0
        scale = np.where(some, 1 / np.sqrt(np.where(some, self.values, 1.0)), 0.0)
        return self.centre.centred(x) @ self.vectors * scale


def solve(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``rows @ inv(upper)`` by substitution from the first column on."""
    out = np.empty_like(rows)
    for j in range(upper.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def factor(gram: np.ndarray, n: int, shifted: bool) -> tuple[np.ndarray, bool]:
    """Upper triangular factor of a Gram matrix, and whether the matrix had to be shifted for it."""
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * np.linalg.norm(gram, 2)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T, False
        except np.linalg.LinAlgError:
            pass
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T, True
        except np.linalg.LinAlgError:
            shift *= 10


def _centre(vectors: DataFrame, d: int) -> Centre:
    """Exact sums: tasks add whole numbers, Spark adds their sums as decimals."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, greatest, n = np.zeros(d, object), 0, 0
        for batch in slices(batches, SOLVE_ROWS):
            x = whole(batch["v"], d)
            sums = sums + x.sum(axis=0)
            greatest = max(greatest, int(abs(x).max(initial=0)))
            n += len(x)
        yield pa.RecordBatch.from_pydict(
            {"i": list(range(d)), "s": [Decimal(int(s)) for s in sums], "m": [greatest] * d,
             "n": [n] * d}, schema=pa.schema([("i", pa.int32()), ("s", pa.decimal128(28, 0)),
                                              ("m", pa.int64()), ("n", pa.int64())]))

    rows = vectors.mapInArrow(add, "i int, s decimal(28,0), m bigint, n bigint").groupBy("i").agg(
        F.sum("s").alias("s"), F.max("m").alias("m"), F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: r.i)
    return Centre(rows[0].n, [int(r.s) for r in rows], max(r.m for r in rows))


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Model | None:
    """The first ``components`` components (all, if there are fewer dimensions) of the usable
    vectors; None if there are none. Every vector counts, also a repeated one.

    Constant or dependent dimensions are no obstacle. Components beyond the rank have the variance
    0.
    """
    d = dimensions(df, vector_col)
    if d is None:
        return None
    vectors = usable(df, d, vector_col).select(F.col(vector_col).alias("v"))
    centre = _centre(vectors, d)

    def gram(factors: list[np.ndarray]) -> np.ndarray:
        def partial(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros((d, d))
            for batch in slices(batches, SOLVE_ROWS):
                rows = centre.centred(whole(batch["v"], d))
                for upper in factors:
                    rows = solve(rows, upper)
                total += rows.T @ rows
            return total

        return matrix_sum(vectors, partial, (d, d))

    factors: list[np.ndarray] = []
    first = gram(factors)
    trace = float(np.trace(first))
    if trace == 0:
        return Model(centre, np.zeros(min(components, d)), np.eye(d)[:, :components],
                     np.zeros(min(components, d)), 1.0)
    composed, matrix, shifted = np.eye(d), first, True
    for step in range(MORE_PASSES):
        if step:
            matrix = gram(factors)
            if step >= PASSES and (not shifted or np.allclose(matrix, np.eye(d), atol=1e-9)):
                break
        upper, shifted = factor(matrix, centre.n, step == 0)
        factors.append(upper)
        composed = upper @ composed
        if step + 1 >= PASSES and not shifted:
            break
    else:  # dependent dimensions: what is left of the last rows belongs to R as well
        values, vectors_ = np.linalg.eigh(gram(factors))
        composed = vectors_ * np.sqrt(np.maximum(values, 0)) @ vectors_.T @ composed
    _, singular, right = np.linalg.svd(composed)
    least = singular[0] * max(centre.n, d) * np.finfo(float).eps
    values = np.where(singular > least, singular, 0.0) ** 2 / centre.n
    model = Model(centre, values[:components], right[:components].T,
                  values[:components] / (trace / centre.n), 0.0)
    return model._replace(identity_error=_identity_error(vectors, model, d))


def _identity_error(vectors: DataFrame, model: Model, d: int) -> float:
    """Largest entry of the covariance of the whitened rows minus the identity."""
    k = model.vectors.shape[1]

    def partial(batches: Iterable[pa.RecordBatch]) -> np.ndarray:
        found = np.zeros((k + 1, k))  # products of centred rows, and their sums in the last line
        for batch in slices(batches, SOLVE_ROWS):
            rows = model.project(whole(batch["v"], d))
            found += np.concatenate([rows.T @ rows, [rows.sum(axis=0)]])
        return found

    found = matrix_sum(vectors, partial, (k + 1, k)) / model.centre.n
    covariance = found[:k] - np.outer(found[k], found[k])
    return float(abs(covariance - np.eye(k)).max())


def whitened(df: DataFrame, model: Model | None, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for every usable
    row and component, components from 1 on by falling variance.

    Rows without a usable vector are left out (see :func:`dimensions`); a null or repeated id stays as it
    is. ``deviation`` is exact in up to 38 digits. Without a model there are no rows. Other columns
    are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, "
              "explained double, identity_error double")
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    d, k = model.vectors.shape
    rows = usable(df, d, vector_col).select(F.col(id_col).alias("vec_id"),
                                            F.col(vector_col).alias("v"))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SOLVE_ROWS):
            x = whole(batch["v"], d)
            n = len(x)
            again = pa.array(np.repeat(np.arange(n), k))
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(again),
                 pa.array(np.tile(np.arange(1, k + 1), n), pa.int32()),
                 pa.array(np.full(n * k, model.centre.n), pa.int64()),
                 model.centre.deviations(x).take(again),
                 pa.array(model.project(x).ravel()),
                 pa.array(np.tile(model.explained, n)),
                 pa.array(np.full(n * k, model.identity_error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                       "identity_error"])

    return rows.mapInArrow(project, schema)
