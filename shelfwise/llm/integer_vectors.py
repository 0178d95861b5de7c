"""Vectors as exact integers, and sums that many tasks share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Integers beyond are too large for distances that fit a long; such vectors take no part.
LIMIT = 1 << 26


def integers(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component as integers; null unless all components have one.

    That is the case for vectors that are null or hold null or non-finite components, or integers of
    ``LIMIT`` or more.
    """
    scaled = F.transform(vector.cast("array<double>"), lambda x: x * F.lit(float(scale)))
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float(LIMIT)))
    return F.when(F.forall(scaled, fits), F.transform(scaled, lambda x: F.floor(x).cast("int")))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1) if len(array) else np.zeros((0, 0), np.int32)


def summed(table: DataFrame, sums: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The total of what ``sums(batches)`` gives for each task, ``size`` integers each.

    A task sends one row for each number that isn't zero, which the map side has added up; the driver
    gets ``size`` numbers, whatever the size of the table.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sums(batches)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["slot", "n"])

    found = table.mapInArrow(of_task, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(size, np.int64)
    for row in found:
        total[row.slot] = row.n
    return total


def moved(old: np.ndarray, totals: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``floor(total / count)`` by component; rows without members stay."""
    return np.where(counts[:, None] > 0, totals // np.maximum(counts, 1)[:, None], old)
