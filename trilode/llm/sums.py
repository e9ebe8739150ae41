"""Matrices summed over the partitions of a table."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

# Partial rows of one matrix row are added in so many groups first.
GROUPS = 32
_ROW = "line int, part int, entries array<double>"


def _add(table: pa.Table) -> pa.Table:
    total = np.zeros(0)
    for entries in table["entries"]:
        found = entries.values.to_numpy()
        total = total + found if len(total) else found
    one = table.slice(0, 1)
    return pa.table({"line": one["line"], "part": pa.array([0], pa.int32()),
                     "entries": pa.array([total], pa.list_(pa.float64()))})


def matrix_sum(df: DataFrame, partial: Callable[[Iterable[pa.RecordBatch]], np.ndarray],
               shape: tuple[int, int]) -> np.ndarray:
    """The sum over all partitions of what ``partial`` makes of a partition's batches.

    Each task holds one matrix. Tasks send it line by line, and lines are added in Spark in two
    steps, so that neither a task nor the driver gets all partial matrices; the driver gets the sum.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = partial(batches).reshape(shape)
        context = TaskContext.get()
        part = context.partitionId() % GROUPS if context else 0
        lines = np.flatnonzero(found.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.int32()), pa.array(np.full(len(lines), part), pa.int32()),
             pa.array(list(found[lines]), pa.list_(pa.float64()))],
            names=["line", "part", "entries"])

    once = df.mapInArrow(send, _ROW).groupBy("line", "part").applyInArrow(_add, _ROW)
    out = np.zeros(shape)
    for row in once.groupBy("line").applyInArrow(_add, _ROW).collect():
        out[row.line] = row.entries
    return out
