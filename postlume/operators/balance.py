"""Spreading small inputs over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame

SMALL_BYTES = 1 << 30
BYTES_PER_TASK = 1 << 17
SMALL_ROWS = 1_000_000
ROWS_PER_TASK = 500


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; for a plain file scan it is the size on disk."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Deal the rows out to the cores if there are few of them.

    A small file often is one row group and so one task, which leaves the other
    cores idle while the texts are annotated; and few rows picked from a large
    source lie in many tasks, each of which would write a file of its own. What
    is not small stays where it is read: the file splits keep every core busy.
    Pass ``rows`` where the number is known; else the size estimate decides.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if rows is not None:
        if rows > SMALL_ROWS:
            return df
        return df.repartition(min(cores, 1 + rows // ROWS_PER_TASK))
    size = estimated_bytes(df)
    if size >= SMALL_BYTES:
        return df
    return df.repartition(min(cores, 1 + size // BYTES_PER_TASK))
