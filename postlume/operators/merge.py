"""Upsert as a join: partial updates by key onto a target frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def coerce(updates: DataFrame, schema: T.StructType, lenient: bool = False, carry: str | None = None) -> DataFrame:
    """Bring the columns to the types of the target, in its order.

    A value that does not fit is an error, or NULL if ``lenient``. ``carry`` is a further SQL expression.

    Timestamps lose their fraction of a second, maps and structs become JSON
    text. Columns the target does not know are an error; absent ones stay absent.
    """
    unknown = sorted(set(updates.columns) - set(schema.names))
    if unknown:
        raise ValueError(f"columns not in the target: {unknown}")

    cast = "TRY_CAST" if lenient else "CAST"
    have = {f.name: f.dataType for f in updates.schema}

    def value(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(have[field.name], (T.MapType, T.StructType)):
            return f"to_json({name}) AS {name}"
        if isinstance(field.dataType, T.TimestampType):
            return f"date_trunc('second', {cast}({name} AS TIMESTAMP)) AS {name}"
        return f"{cast}({name} AS {field.dataType.simpleString()}) AS {name}"

    return updates.selectExpr(*[value(f) for f in schema if f.name in have], *([carry] if carry else []))


def merge_frames(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                 small_updates: bool = False) -> DataFrame:
    """``target`` after the upsert of ``updates``; both unique by ``keys``.

    Matched rows take the columns that ``updates`` carries, NULLs included, and
    keep the others; unmatched updates are added with NULL in the others. One
    full outer join on the keys. With ``small_updates`` (the caller has checked
    their size) they are broadcast to the target instead, whose rows then do not
    move.
    """
    keys = list(keys)
    carried = [name for name in updates.columns if name not in keys]
    new = updates.selectExpr(*[f"`{k}`" for k in keys], "true AS _matched",
                             *[f"`{name}` AS `_new_{name}`" for name in carried])
    columns = [f"CASE WHEN _matched THEN `_new_{name}` ELSE `{name}` END AS `{name}`"
               if name in carried else f"`{name}`" for name in target.columns]
    if not small_updates:
        return target.join(new, keys, "full_outer").selectExpr(*columns)

    kept = target.join(F.broadcast(new), keys, "left").selectExpr(*columns)
    matched = target.select(*keys).join(F.broadcast(updates.select(*keys)), keys, "left_semi")
    added = updates.join(F.broadcast(matched), keys, "left_anti")
    return kept.unionByName(added, allowMissingColumns=True).select(*target.columns)
