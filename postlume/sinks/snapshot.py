"""Upsertable table on plain Parquet folders.

Every commit writes new folders ``data/c=<commit>/date=<day>`` and then one
small file that lists the folders in force. Readers take the newest list, so
they see a commit whole or not at all, and no file in use is overwritten. A
commit whose keys are all new only adds folders; otherwise exactly the folders
that hold a matched key are rewritten.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlume import schema as S
from postlume.operators.modules import target_schema
from postlume.operators.merge import coerce, merge_frames
from postlume.session import broadcast_limit
from postlume.sinks.files import Files


#: Writers of one process take turns, by table, once their rows are written.
_turns: dict[str, threading.Lock] = defaultdict(threading.Lock)


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since this one read the table."""


@dataclass(frozen=True)
class Upserted:
    inserted: int = 0
    updated: int = 0
    rewritten_folders: int = 0


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None,
                 keys: Sequence[str] = S.KEYS, partition: str | None = S.PARTITION):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema, self.keys, self.partition = schema or target_schema(), list(keys), partition
        self._files = Files(spark, self.path)

    # -- versions ----------------------------------------------------------

    def version(self) -> int | None:
        """Number of the newest commit; None if the table does not exist."""
        numbers = [int(n[:-5]) for n in self._files.names(f"{self.path}/commits")
                   if n.endswith(".json")]
        return max(numbers, default=None)

    def _folders(self, version: int | None) -> list[str]:
        if version is None:
            return []
        return json.loads(self._files.read(f"{self.path}/commits/{version:010d}.json"))["folders"]

    def _commit(self, after: int | None, folders: list[str]) -> None:
        number = 0 if after is None else after + 1
        text = json.dumps({"version": number, "folders": sorted(folders)})
        if not self._files.create(f"{self.path}/commits/{number:010d}.json", text):
            raise ConcurrentCommit(f"version {number} of {self.path} exists already")

    def create(self) -> SnapshotTable:
        """Create the table, empty, unless it exists."""
        if self.version() is None:
            try:
                self._commit(None, [])
            except ConcurrentCommit:
                pass
        return self

    # -- reading -----------------------------------------------------------

    def _open(self, folders: list[str]) -> DataFrame:
        """Rows of these folders, with the commit that wrote them as ``c``."""
        layout = T.StructType([f for f in self.schema if f.name != self.partition]
                              + [T.StructField("c", T.StringType())]
                              + [f for f in self.schema if f.name == self.partition])
        if not folders:
            return self.spark.createDataFrame([], layout)
        return (self.spark.read.schema(layout).option("basePath", f"{self.path}/data")
                .parquet(*[f"{self.path}/data/{folder}" for folder in folders]))

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        return self._open(self._folders(version)).select(*self.schema.names)

    def is_empty(self) -> bool:
        return not self._folders(self.version())

    # -- writing -----------------------------------------------------------

    def _write(self, frame: DataFrame) -> list[str]:
        commit = f"c=w{uuid.uuid4().hex}"
        if self.partition and self.partition not in frame.columns:
            frame = frame.withColumn(
                self.partition, F.lit(None).cast(self.schema[self.partition].dataType))
        writer = frame.write.option("compression", "snappy")
        if not self.partition:
            writer.parquet(f"{self.path}/data/{commit}")
            return [commit]
        writer.partitionBy(self.partition).parquet(f"{self.path}/data/{commit}")
        return [f"{commit}/{name}" for name in self._files.names(f"{self.path}/data/{commit}")
                if name.startswith(f"{self.partition}=")]

    def upsert(self, updates: DataFrame, absent_at: int | None = None) -> Upserted:
        """Merge ``updates``, unique by key, into the table: see ``merge_frames``.

        The updates are written first. If no key of theirs is in the table those
        folders are the commit, and nothing is written twice. ``absent_at`` names
        a version that is known to hold none of the keys: as long as it is the
        newest, the keys of the table need not be read again.
        """
        missing = [k for k in self.keys if k not in updates.columns]
        if missing:
            raise ValueError(f"updates lack the key columns {missing}")
        counted = Observation()
        staged_folders = self._write(coerce(updates, self.schema).observe(counted, F.count(F.lit(1)).alias("rows")))
        # Counted by the tasks that write: a task that runs again replaces its count.
        rows = (counted.get or {}).get("rows") if staged_folders else None
        if not rows:
            return Upserted()
        present = [f.name for f in self.schema if f.name in updates.columns]
        with _turns[self.path]:
            return self._merge(self._open(staged_folders).select(*present), staged_folders, rows, absent_at)

    def _merge(self, staged: DataFrame, staged_folders: list[str], rows: int, absent_at: int | None) -> Upserted:
        version = self.version()
        live = self._folders(version)
        touched, matched = [], 0
        if live and (absent_at is None or absent_at != version):
            place = ["c"] + ([self.partition] if self.partition else [])
            hits = (self._open(live).select(*self.keys, *place)
                    .join(staged.select(*self.keys), self.keys, "left_semi")
                    .groupBy(*place).count())
            # One row per folder of the table, the same that the commit file lists.
            for row in hits.collect():
                matched += row["count"]
                touched.append(self._folder_name(row))
        if not touched:
            self._commit(version, live + staged_folders)
            return Upserted(inserted=rows)

        size = sum(self._files.size(f"{self.path}/data/{f}") for f in staged_folders)
        merged = merge_frames(self._open(touched).select(*self.schema.names), staged, self.keys,
                              small_updates=size <= broadcast_limit(self.spark))
        if self.partition and len(touched) > 1:
            # Rows of a day together, large days split: no file per task and day.
            merged = merged.hint("rebalance", self.partition)
        kept = [f for f in live if f not in set(touched)]
        self._commit(version, kept + self._write(merged))
        self._files.remove(f"{self.path}/data/{staged_folders[0].split('/')[0]}")
        return Upserted(rows - matched, matched, len(touched))

    def _folder_name(self, row) -> str:
        if not self.partition:
            return f"c={row['c']}"
        day = row[self.partition]
        value = "__HIVE_DEFAULT_PARTITION__" if day is None else str(day)
        return f"c={row['c']}/{self.partition}={value}"
