"""Connected components by joins, and tables kept in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlume.session import shared_dir


def stored(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: its lineage ends there, lost executors or not."""
    path = f"{shared_dir(frame.sparkSession)}/llm-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the smallest node that it is linked to,
    however far. Each round takes the smallest label among the neighbours, then the label's label."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b"))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        heard = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        moved = labels.join(heard, "node").select(
            "node", F.least("label", "heard").alias("to"), F.col("label").alias("old"))
        # The label is a node too: what it has found by now holds for those that carry it.
        further = stored(moved.join(
            moved.select(F.col("node").alias("to"), F.col("to").alias("next")), "to", "left").select(
            "node", F.least("to", "next").alias("label"), "old"))
        if further.where("label <> old").isEmpty():
            return further.select("node", "label")
        labels = further.select("node", "label")
