"""Rows with vectors: which ones count, their numbers as matrices, and a search of all rows in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether there is a vector, and all its entries are numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & good, F.lit(False))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, matrix) for each length of a vector; the vectors hold no nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, values[offsets[rows][:, None] + np.arange(length)]


def id_order(ids: pa.ChunkedArray) -> np.ndarray:
    """Places of the rows by ascending id, null ids last."""
    return np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy()))


def integer_products(left: np.ndarray, right: np.ndarray, limit: int = 1 << 62) -> np.ndarray:
    """Exact inner products of rows of integers, in floating point wherever every partial sum fits in
    its mantissa. Beyond ``limit``, at most 2^63 - 1, they are cut to that."""
    most = left.shape[1]
    for side in (left, right):
        most *= max(int(side.max(initial=0)), -int(side.min(initial=0)))
    for kind, bits in ((np.float32, 24), (np.float64, 53), (np.int64, 62)):
        if most < 1 << bits:
            return (left.astype(kind) @ right.astype(kind).T).astype(np.int64)
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -limit, limit).astype(np.int64)


def first_of_groups(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group: the highest scores, ties by the smaller id."""
    order = np.lexsort((ids, -scores, groups))
    ordered = groups[order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.arange(len(order))
    return order[at - np.maximum.accumulate(np.where(new, at, 0)) < k]


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with a number of their own, ``_row``. Store the frame before using it twice."""
    return rows.withColumn("_row", F.monotonically_increasing_id())


def in_blocks(queries: DataFrame, rows: DataFrame, cell: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
              strip: int, column: int) -> DataFrame:
    """``cell(queries, rows)`` for every block of about ``strip`` queries against every block of about
    ``column`` rows.

    Both sides carry ``_row``, whose hash deals them out evenly, whatever repeats in them. A query travels
    once per block of rows and a row once per block of queries; what a task holds is one block of each.
    """
    strips = max(1, -(-queries.count() // strip))
    columns = max(1, -(-rows.count() // column))

    def dealt(frame: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        # New names for the columns: both sides may come from one frame.
        return frame.toDF(*frame.columns).withColumns({own: F.pmod(F.xxhash64("_row"), F.lit(n)),
                                  other: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))})

    left = dealt(queries, "_strip", strips, "_column", columns).groupBy("_strip", "_column")
    right = dealt(rows, "_column", columns, "_strip", strips).groupBy("_strip", "_column")
    return left.cogroup(right).applyInArrow(cell, schema)
