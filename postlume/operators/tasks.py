"""Annotation tasks: what is asked, what comes back, and what stands in for it."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlume import schema as S
from postlume.functions.text import quoted


@dataclass(frozen=True)
class Task:
    """One structured question about a text.

    ``defaults`` answer a blank text or a failed call; ``malformed`` overrides
    them where the answer came back but is no JSON object. ``vocabulary`` limits
    single-valued fields, ``list_vocabulary`` the elements of list fields.
    """

    name: str
    fields: T.StructType
    defaults: dict
    instructions: str
    question: Callable[[Column, Column], Column]
    temperature: float
    malformed: dict = field(default_factory=dict)
    vocabulary: dict = field(default_factory=dict)
    list_vocabulary: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.fields.names

    def answer_schema(self) -> str:
        """The expected answer as JSON schema text, for clients that force one."""
        kinds = {"string": {"type": "string"}, "double": {"type": "number"},
                 "boolean": {"type": "boolean"},
                 "array": {"type": "array", "items": {"type": "string"}}}
        properties = {}
        for f in self.fields:
            properties[f.name] = dict(kinds[f.dataType.typeName()])
            if f.name in self.vocabulary:
                properties[f.name]["enum"] = list(self.vocabulary[f.name])
            if f.name in self.list_vocabulary:
                properties[f.name]["items"] = {
                    "type": "string", "enum": list(self.list_vocabulary[f.name])}
        return json.dumps({"type": "object", "properties": properties,
                           "required": self.columns})


def _about(*lines: str) -> Callable[[Column, Column], Column]:
    lead = "\n".join(lines) + "\n\nPost:\n"
    return lambda text, author: F.concat(F.lit(lead), text)


def _about_with_author(*lines: str) -> Callable[[Column, Column], Column]:
    lead = "\n".join(lines) + "\n\nPost:\n"

    def question(text: Column, author: Column) -> Column:
        by = F.when(F.coalesce(author, F.lit("")) != "", F.concat(F.lit("\n\nWritten by: "), author))
        return F.concat(F.lit(lead), text, F.coalesce(by, F.lit("")))

    return question


SENTIMENT = Task(
    "sentiment", S.SENTIMENT, S.SENTIMENT_DEFAULTS,
    instructions="You judge the mood of posts from social networks.",
    question=_about(
        "State the mood of the post below: positive, negative or neutral, how sure you are "
        "from 0 to 1, the emotions it shows and the themes it is about."),
    temperature=0.3,
    malformed={"sentiment_label": "unknown"},
    vocabulary={"sentiment_label": S.SENTIMENT_LABELS},
)
ENTITIES = Task(
    "entities", S.ENTITIES, S.ENTITY_DEFAULTS,
    instructions="You list the names that occur in posts from social networks.",
    question=_about(
        "List the people, organizations, locations, products, hashtags and mentioned users "
        "(without the @) that the post below names. Leave out what it does not name."),
    temperature=0.2,
)
TOPIC = Task(
    "topic", S.TOPIC, S.TOPIC_DEFAULTS,
    instructions="You sort posts from social networks by subject.",
    question=_about_with_author(
        "Give the subject of the post below: one category of " + ", ".join(S.CATEGORIES)
        + "; narrower subjects; the industry; its key terms; whether it advertises "
          "something; whether it is news."),
    temperature=0.2,
    vocabulary={"primary_category": S.CATEGORIES},
)
MODERATION = Task(
    "moderation", S.MODERATION, S.MODERATION_DEFAULTS,
    instructions="You check posts from social networks against content rules.",
    question=_about(
        "Check the post below. Is it safe for everyone? Give the risk level ("
        + ", ".join(S.RISK_LEVELS) + "), the flags that apply (" + ", ".join(S.FLAGS)
        + "), warnings for the reader, the action to take (" + ", ".join(S.ACTIONS)
        + ") and how sure you are from 0 to 1."),
    temperature=0.1,
    vocabulary={"risk_level": S.RISK_LEVELS, "recommended_action": S.ACTIONS},
    list_vocabulary={"flags": S.FLAGS},
)
TASKS = {task.name: task for task in (SENTIMENT, ENTITIES, TOPIC, MODERATION)}


def register_task(task: Task) -> Task:
    """Add a task for the model backend; modules name it."""
    TASKS[task.name] = task
    return task


def _literal(value, kind: T.DataType) -> str:
    """The default values as SQL: texts, numbers, booleans and empty lists."""
    if isinstance(value, list):
        return f"CAST(array() AS {kind.simpleString()})"
    return f"'{value}'" if isinstance(value, str) else f"CAST({value} AS {kind.simpleString()})"


def with_answer(df: DataFrame, task: Task, answer: str, asked: str) -> DataFrame:
    """Add the task's columns and ``<task>_status`` from the JSON text in ``answer``.

    ``asked`` names a boolean column. Status: ``blank`` (not asked), ``failed``
    (no answer), ``malformed`` (no JSON object), ``unknown_value`` (outside the
    vocabulary), ``partial`` (a field missing or of the wrong type), ``ok``. A
    field that cannot be used takes its default; keys beyond the schema are
    dropped.
    """
    # One parse tells the fields and whether anything was odd; only an odd answer is parsed again, to see
    # whether it is an object at all.
    fields = T.StructType([*task.fields, T.StructField("_odd", T.StringType())])
    df = df.withColumn("_parsed", F.from_json(
        F.col(answer), fields, {"columnNameOfCorruptRecord": "_odd", "allowNonNumericNumbers": "false"}))
    df = df.withColumn("_state", F.expr(f"""
        CASE WHEN NOT {asked} THEN 'blank' WHEN {answer} IS NULL THEN 'failed' WHEN _parsed IS NULL THEN 'malformed'
             WHEN _parsed._odd IS NOT NULL AND json_object_keys({answer}) IS NULL THEN 'malformed' ELSE 'usable' END"""))
    columns, unknown, missing = {}, ["false"], []
    for f in task.fields:
        value = accepted = f"_parsed.{f.name}"
        missing.append(f"{value} IS NULL")
        if f.name in task.vocabulary:
            known = f"{value} IN ({quoted(task.vocabulary[f.name])})"
            unknown.append(f"coalesce(NOT ({known}), false)")
            accepted = f"CASE WHEN {known} THEN {value} END"
        elif f.name in task.list_vocabulary:
            accepted = f"filter({value}, v -> v IN ({quoted(task.list_vocabulary[f.name])}))"
            unknown.append(f"coalesce(size({accepted}) < size({value}), false)")
        default = _literal(task.defaults[f.name], f.dataType)
        malformed = _literal({**task.defaults, **task.malformed}[f.name], f.dataType)
        columns[f.name] = F.expr(f"""
            CASE _state WHEN 'usable' THEN coalesce({accepted}, {default})
                        WHEN 'malformed' THEN {malformed} ELSE {default} END""")
    columns[f"{task.name}_status"] = F.expr(f"""
        CASE WHEN _state <> 'usable' THEN _state WHEN {' OR '.join(unknown)} THEN 'unknown_value'
             WHEN {' OR '.join(missing)} THEN 'partial' ELSE 'ok' END""")
    return df.withColumns(columns).drop("_parsed", "_state")
