"""Instants: literals, and ISO-8601 text as a post's time of publication."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DATE = (r"(?:(\d{4})-(\d{2})-(\d{2})|(\d{4})(\d{2})(\d{2})"
         r"|(\d{4})-W(\d{2})(?:-(\d))?|(\d{4})W(\d{2})(\d)?)")
_TIME = (r"(?:([01]\d|2[0-3])(?::([0-5]\d)(?::([0-5]\d)(?:[.,](\d+))?)?)?"
         r"|([01]\d|2[0-3])([0-5]\d)(?:([0-5]\d)(?:[.,](\d+))?)?)")
_OFFSET = (r"(?:([+-])([01]\d|2[0-3])"
           r"(?::([0-5]\d)(?::([0-5]\d))?|([0-5]\d)([0-5]\d)?)?)")
ISO_8601 = rf"^(?!0000){_DATE}(?:[\s\S]{_TIME}{_OFFSET}?)?\z"
# What the groups mean, those of alternative notations side by side: of two only
# one takes part in a match, and the other adds nothing.
_LAYOUT = {"year": "$1$4", "month": "$2$5", "day": "$3$6",
           "week_year": "$7$10", "week": "$8$11", "weekday": "$9$12",
           "hour": "$13$17", "minute": "$14$18", "second": "$15$19", "fraction": "$16$20",
           "sign": "$21", "offset_hour": "$22", "offset_minute": "$23$25",
           "offset_second": "$24$26"}


def instant(as_of: datetime) -> Column:
    """A timestamp literal; a naive value is UTC."""
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return F.lit(as_of)


def iso_parts(name: str) -> Column:
    """The parts of an ISO-8601 text column, in the order above; NULL if it is none.

    One replacement lays out all parts at once, so that the pattern runs twice
    per value and not once per part.
    """
    utc = f"replace({name}, 'Z', '+00:00')"
    layout = "|".join(_LAYOUT.values())
    return F.expr(f"CASE WHEN {utc} RLIKE r'{ISO_8601}' THEN "
                  rf"split(regexp_replace({utc}, r'{ISO_8601}', '{layout}'), r'\|', -1) END")


def iso_instant(parts: str) -> Column:
    """The instant that the column ``parts`` (see ``iso_parts``) stands for.

    A calendar or a week date, any time of day, minus the offset; no offset
    means UTC. NULL for days that do not exist.
    """
    text = {name: f"{parts}[{i}]" for i, name in enumerate(_LAYOUT)}

    def number(name: str, default: int = 0) -> str:
        return f"CASE WHEN {text[name]} = '' THEN {default} ELSE CAST({text[name]} AS INT) END"

    calendar = (f"try_make_timestamp({number('year')}, {number('month')}, {number('day')}, "
                "0, 0, 0, 'UTC')")
    year, week, weekday = number("week_year"), number("week"), number("weekday", default=1)
    # 4 January always lies in week 1; the Thursday decides whose year a week is.
    monday = f"date_add(trunc(make_date({year}, 1, 4), 'week'), (({week}) - 1) * 7)"
    week_date = (f"CASE WHEN ({week}) >= 1 AND ({weekday}) BETWEEN 1 AND 7 "
                 f"AND year(date_add({monday}, 3)) = ({year}) "
                 f"THEN CAST(date_add({monday}, ({weekday}) - 1) AS TIMESTAMP) END")
    day = f"CASE WHEN {text['year']} <> '' THEN {calendar} ELSE {week_date} END"

    def seconds(prefix: str = "") -> str:
        return (f"(({number(prefix + 'hour')}) * 3600 + ({number(prefix + 'minute')}) * 60"
                f" + ({number(prefix + 'second')}))")

    offset = (f"CASE WHEN {text['sign']} = '' THEN 0 WHEN {text['sign']} = '-' "
              f"THEN -{seconds('offset_')} ELSE {seconds('offset_')} END")
    micros = (f"CASE WHEN {text['fraction']} = '' THEN 0 ELSE "
              f"CAST(substring(rpad({text['fraction']}, 6, '0'), 1, 6) AS INT) END")
    return F.expr(f"""
        CASE WHEN {parts} IS NOT NULL THEN timestamp_micros(
            unix_micros({day}) + ({seconds()} - ({offset})) * 1000000L + ({micros})) END""")


def with_posted_instant(df: DataFrame, name: str, out: str) -> DataFrame:
    """Add a source's time column as timestamp, by the type it has in the source.

    ISO-8601 text is parsed, anything else in it is NULL. A plain cast would also
    take partial dates and bare times (as today's), and refuse the basic forms.
    A timestamp without zone is UTC; a bare date is its midnight in UTC (see
    ``day_only`` for how it scores); every other type gives NULL.
    """
    kind = df.select(name).schema[0].dataType
    if isinstance(kind, T.TimestampType):
        return df.withColumn(out, F.col(name))
    if isinstance(kind, T.TimestampNTZType):
        return df.withColumn(out, F.col(name).cast("timestamp"))
    if isinstance(kind, (T.StringType, T.VarcharType, T.CharType)):
        # Two steps: the second refers to the groups often, the first runs once.
        return (df.withColumn("_iso", iso_parts(name)).withColumn(out, iso_instant("_iso"))
                .drop("_iso"))
    if isinstance(kind, T.DateType):
        return df.withColumn(out, F.col(name).cast("timestamp"))
    return df.withColumn(out, F.lit(None).cast("timestamp"))


def day_only(df: DataFrame, name: str | None) -> bool:
    """Whether a source's time column holds bare dates: stored, but without an instant to score by."""
    return bool(name) and isinstance(df.select(name).schema[0].dataType, T.DateType)
