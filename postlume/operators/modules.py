"""Enrichment modules: named groups of columns that a run can switch on and off."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlume import schema as S
from postlume.functions.engagement import with_engagement
from postlume.functions.timestamps import instant
from postlume.operators.rules import annotate_by_rules


@dataclass(frozen=True)
class Module:
    """``transform(posts, as_of)`` adds exactly the columns of ``fields``.

    ``task`` names the annotation task behind it, if any: those modules share
    one pass over the text. ``prepare`` runs once when a run starts; if it fails
    the module is off for that run.
    """

    name: str
    fields: T.StructType
    transform: Callable[[DataFrame, datetime], DataFrame] | None = None
    task: str | None = None
    prepare: Callable[[], None] | None = None


_modules: dict[str, Module] = {m.name: m for m in (
    Module("sentiment", S.SENTIMENT, task="sentiment"),
    Module("entity", S.ENTITIES, task="entities"),
    Module("topic", S.TOPIC, task="topic"),
    Module("engagement", S.ENGAGEMENT, transform=with_engagement),
    Module("moderation", S.MODERATION, task="moderation"),
)}


def register_module(module: Module) -> Module:
    _modules[module.name] = module
    return module


@contextmanager
def added(*modules: Module) -> Iterator[None]:
    """Have further modules, for what is planned inside the block."""
    before = dict(_modules)
    for module in modules:
        register_module(module)
    try:
        yield
    finally:
        _modules.clear()
        _modules.update(before)


def target_schema() -> T.StructType:
    """The enrichment table with the columns of modules added later."""
    known = set(S.ENRICHMENTS.names)
    extra = [f for m in _modules.values() for f in m.fields if f.name not in known]
    metadata = S.METADATA.names
    return T.StructType([f for f in S.ENRICHMENTS if f.name not in metadata] + extra
                        + [f for f in S.ENRICHMENTS if f.name in metadata])


def switched_on(switches: Mapping[str, bool | str] | Sequence[str] | None = None,
                ) -> tuple[list[Module], dict[str, str]]:
    """Modules of a run, and why the others that were asked for are off.

    A mapping switches off what it does not set to ``True`` or to the word
    "true", in any case; modules it does not mention stay on. A list names the
    modules to use.
    """
    if switches is None:
        wanted = list(_modules)
    elif isinstance(switches, Mapping):
        wanted = [n for n in _modules if str(switches.get(n, True)).lower() == "true"]
    else:
        wanted = [n for n in _modules if n in set(switches)]
    on, failed = [], {}
    for name in wanted:
        module = _modules[name]
        try:
            if module.prepare:
                module.prepare()
            on.append(module)
        except Exception as error:  # a module that cannot start must not stop the run
            failed[name] = str(error)
    return on, failed


def enrich(posts: DataFrame, modules: Sequence[Module], as_of: datetime,
           annotate: Callable[[DataFrame, Sequence[str]], DataFrame] = annotate_by_rules,
           version: str = S.ENRICHMENT_VERSION, day_only: bool = False) -> DataFrame:
    """Normalised posts to rows of the target: metadata, module columns, target names.

    Only the columns of the given modules appear, so that an upsert leaves those
    of the others alone. With the rule backend this is one pass without shuffle.
    ``day_only``: the source's times are bare dates. They are stored, but modules
    see no time of publication, as a day has no instant.
    """
    moment = instant(as_of)
    df = posts.withColumns({"enriched_at": moment, "enrichment_version": F.lit(version),
                            "date": F.to_date(moment)})
    if day_only:
        df = df.withColumns({"_posted_day": F.col("posted_at"), "posted_at": F.lit(None).cast("timestamp")})
    df = annotate(df, [m.task for m in modules if m.task])
    for module in modules:
        if module.transform:
            df = module.transform(df, as_of)
    if day_only:
        df = df.withColumn("posted_at", F.col("_posted_day")).drop("_posted_day")
    df = df.withColumnsRenamed(S.TARGET_NAMES)
    return df.select(*[f.name for f in target_schema() if f.name in df.columns])
