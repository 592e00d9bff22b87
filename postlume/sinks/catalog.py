"""Targets that live in a catalog: DDL, and upsert where the table format has MERGE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlume import schema as S
from postlume.operators.merge import coerce
from postlume.operators.modules import target_schema


def create_table(spark: SparkSession, name: str, schema: T.StructType | None = None,
                 partition: str | None = S.PARTITION, using: str = "parquet",
                 location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS``, Snappy Parquet, partitioned by day."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema or target_schema())
    codec = {"parquet": "'compression' = 'snappy'"}.get(
        using, "'write.format.default' = 'parquet', 'write.parquet.compression-codec' = 'snappy'")
    clauses = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {using}"]
    if partition:
        clauses.append(f"PARTITIONED BY (`{partition}`)")
    if location:
        clauses.append("LOCATION '" + location.replace("'", "\\'") + "'")
    clauses.append(f"TBLPROPERTIES ({codec})")
    spark.sql(" ".join(clauses))


class CatalogTable:
    """Same interface as ``SnapshotTable``, for a catalog table with MERGE."""

    def __init__(self, spark: SparkSession, name: str, schema: T.StructType | None = None,
                 keys: Sequence[str] = S.KEYS, using: str = "iceberg"):
        self.spark, self.name, self.schema = spark, name, schema or target_schema()
        self.keys, self.using = list(keys), using

    def create(self) -> CatalogTable:
        create_table(self.spark, self.name, self.schema, using=self.using)
        return self

    def version(self) -> None:
        return None

    def read(self, version: None = None) -> DataFrame:
        return self.spark.table(self.name).select(*self.schema.names)

    def is_empty(self) -> bool:
        return self.read().isEmpty()

    def upsert(self, updates: DataFrame, absent_at: None = None):
        """Counts come back as None: MERGE does not report them."""
        from postlume.sinks.snapshot import Upserted

        rows = coerce(updates, self.schema).alias("source")
        on = None
        for key in self.keys:
            same = F.col(f"{self.name}.{key}") == F.col(f"source.{key}")
            on = same if on is None else on & same
        values = {c: F.col(f"source.{c}") for c in rows.columns}
        changes = {c: v for c, v in values.items() if c not in self.keys}
        (rows.mergeInto(self.name, on)
         .whenMatched().update(changes).whenNotMatched().insert(values).merge())
        return Upserted(None, None)
