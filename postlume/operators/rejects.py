"""Rows that do not fit the target are set aside, one by one, so that the others are stored."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlume.operators.merge import coerce

REJECTS = "reasons map<string,string>"
_WIDER = {"tinyint": 1, "smallint": 2, "int": 3, "bigint": 4}


def can_fail(have: T.DataType, want: T.DataType) -> bool:
    """Whether a cast between the types can fail for some value."""
    a, b = have.simpleString(), want.simpleString()
    if a == b or isinstance(want, T.StringType) or isinstance(have, T.NullType):
        return False
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return can_fail(have.elementType, want.elementType)
    if a in _WIDER and (b in _WIDER and _WIDER[a] <= _WIDER[b] or b in ("float", "double")):
        return False
    if (a, b) in (("float", "double"), ("double", "float")) or b == "boolean" and a in _WIDER:
        return False
    times = ("date", "timestamp", "timestamp_ntz")
    return not (a in times and b in times)


def verdict(updates: DataFrame, schema: T.StructType, keys: Sequence[str] = ()) -> str | None:
    """SQL for the reasons to reject a row, as a map of column and its value as text; empty if it fits. None
    where no row of these types can fail. ``keys`` may not be NULL."""
    have, faults = {f.name: f.dataType for f in updates.schema}, []
    for field in schema:
        name = f"`{field.name}`"
        if field.name in keys:
            faults.append((field.name, f"{name} IS NULL", "'no key'"))
        if field.name in have and not isinstance(have[field.name], (T.MapType, T.StructType)) and can_fail(have[field.name], field.dataType):
            kind = field.dataType.simpleString()
            failed = f"{name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL"
            if isinstance(field.dataType, T.ArrayType):  # an element that fails is NULL inside the list
                failed += f" OR exists({name}, v -> v IS NOT NULL AND TRY_CAST(v AS {field.dataType.elementType.simpleString()}) IS NULL)"
            faults.append((field.name, failed, f"CAST({name} AS STRING)"))
    if not faults:
        return None
    entries = ", ".join(f"CASE WHEN {failed} THEN struct('{name}', {value}) END" for name, failed, value in faults)
    return f"map_from_entries(array_compact(array({entries})))"


def separate(updates: DataFrame, schema: T.StructType, keys: Sequence[str], folder: str,
             rejects: str | None = None, check_keys: bool = False) -> tuple[DataFrame, Callable[[], int]]:
    """The rows that fit ``schema``, in its types, and a function that tells how many do not.

    One pass stages both kinds in ``folder``; those that do not fit are added to the table at ``rejects``, as
    their keys and ``reasons``. Types that cannot fail are passed through as they are, with nothing staged.
    """
    reasons = verdict(updates, schema, keys if check_keys else ())
    if reasons is None:
        return updates, lambda: 0
    spark, rows = updates.sparkSession, Observation()
    judged = coerce(updates, schema, lenient=True, carry=f"{reasons} AS reasons").withColumn("fits", F.size("reasons") == 0)
    judged.observe(rows, F.count_if(~F.col("fits")).alias("n")).write.partitionBy("fits").parquet(folder)
    columns = T.StructType([f for f in judged.schema if f.name != "fits"])
    staged = spark.read.schema(T.StructType([*columns, T.StructField("fits", T.BooleanType())])).parquet(folder)
    rejected = (rows.get or {}).get("n") or 0
    if rejects and rejected:
        staged.where("NOT fits").select(*keys, "reasons").write.mode("append").parquet(rejects)
    return staged.where("fits").drop("fits", "reasons"), lambda: rejected
