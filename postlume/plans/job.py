"""The batch job: every source, what is new in it, enriched, into one table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postlume import schema as S
from postlume.functions.timestamps import day_only
from postlume.operators.balance import spread_small
from postlume.operators.model import ModelBackend, annotate_by_model, status_counts
from postlume.operators.modules import Module, enrich, switched_on, target_schema
from postlume.operators.rules import annotate_by_rules
from postlume.operators.rejects import separate
from postlume.operators.select import dedup_posts, next_candidates, not_enriched
from postlume.session import configure, shared_dir
from postlume.sinks.files import Files
from postlume.sources.posts import normalize, source_keys
from postlume.sources.providers import Provider, choose

_CANDIDATES = "source_id string, scraped_at timestamp"
_PENDING = "source_id string, oldest timestamp, any_undated boolean, copies bigint"


@dataclass
class ProviderReport:
    """``fetched`` counts selected rows, ``enriched`` what was committed, ``rejected`` the posts that
    do not fit the table, ``null_ids`` the rows that were dropped because they have no id."""

    fetched: int = 0
    null_ids: int = 0
    enriched: int = 0
    rejected: int = 0
    inserted: int | None = 0
    updated: int | None = 0
    skipped: str | None = None
    statuses: dict = field(default_factory=dict)


@dataclass
class RunReport:
    providers: dict[str, ProviderReport] = field(default_factory=dict)
    unknown_providers: list[str] = field(default_factory=list)
    modules_off: dict[str, str] = field(default_factory=dict)

    @property
    def total_enriched(self) -> int:
        return sum(p.enriched for p in self.providers.values())


def selected_posts(source: DataFrame, provider: Provider, wanted: DataFrame,
                   oldest: datetime | None, any_undated: bool, newest: datetime | None = None) -> DataFrame:
    """The normalised posts, those with a text, of the (source_id, scraped_at) in ``wanted``.

    ``oldest`` and ``newest`` become literal bounds on the scan, which skip the row groups of
    other times; the semi-join is a broadcast if ``wanted`` is small on disk.
    """
    posts = normalize(source, provider)
    if oldest is not None:
        known = F.col("scraped_at") >= F.lit(oldest)
        if newest is not None:
            known = known & (F.col("scraped_at") <= F.lit(newest))
        posts = posts.where(known | F.col("scraped_at").isNull() if any_undated else known)
    w = wanted.select(F.col("source_id").alias("_id"), F.col("scraped_at").alias("_at"))
    return posts.join(w, (F.col("source_id") == F.col("_id"))
                      & F.col("scraped_at").eqNullSafe(F.col("_at")), "left_semi")


@dataclass
class _Selection:
    """Posts to enrich, unique by key, or None; ``fetched`` tells their rows before copies folded, once they are read."""

    posts: DataFrame | None
    null_ids: int
    fetched: Callable[[], int]


def _observed(counts: Observation, name: str) -> int:
    """A count taken on the way; nothing if Spark found that there was nothing to run."""
    return (counts.get or {}).get(name) or 0


def select_newest(source: DataFrame, provider: Provider, done: DataFrame | None, limit: int,
                  folder: str) -> _Selection:
    """The ``limit`` newest rows that have a text and are not enriched.

    Candidates come by time and id alone. Only their posts are then read, within the row groups of their
    times; as long as too few of them have a text, the next ones are taken, from where the last step ended, twice as
    many each time. Rows that share id and time count as often as they have a text.
    """
    spark = source.sparkSession
    keys = source_keys(source, provider)
    ids, last, have, parts, n = Observation(), None, 0, [], limit
    while have < limit:
        step = f"{folder}/step{len(parts)}"
        candidates = keys if last else keys.observe(ids, F.count_if(F.col("source_id").isNull()).alias("null"))
        next_candidates(candidates, done, last, n).write.parquet(f"{step}-ids")
        wanted = spark.read.schema(_CANDIDATES).parquet(f"{step}-ids")
        span = wanted.agg(F.min("scraped_at").alias("oldest"), F.max("scraped_at").alias("newest"),
                          F.max(F.col("scraped_at").isNull()).alias("any_undated"),
                          F.max_by(F.struct("scraped_at", "source_id"), F.struct(
                              F.col("scraped_at").isNull(), -F.unix_micros("scraped_at"), "source_id")).alias("last")).first()
        if span["last"] is None:
            break
        rows = Observation()
        selected_posts(source, provider, wanted, span["oldest"], span["any_undated"], span["newest"]).observe(
            rows, F.count(F.lit(1)).alias("n")).write.parquet(f"{step}-posts")
        have += _observed(rows, "n")
        parts.append(f"{step}-posts")
        last, n = tuple(span["last"]), 2 * n
    if not have:
        return _Selection(None, _observed(ids, "null"), lambda: 0)
    posts = spark.read.schema(S.NORMALIZED).parquet(*parts)
    if have > limit:
        posts = posts.orderBy(F.col("scraped_at").desc_nulls_last(), "source_id").limit(limit)
    return _Selection(dedup_posts(posts, S.KEYS), _observed(ids, "null"), lambda: min(have, limit))


def select_all(source: DataFrame, provider: Provider, done: DataFrame | None, folder: str) -> _Selection:
    """All rows that have a text and are not enriched, the newest of each id.

    Ids and times alone go through the anti-join. Rows without an id fold into one row there, which counts them.
    """
    spark = source.sparkSession
    folded = source_keys(source, provider).groupBy("source_id").agg(
        F.min("scraped_at").alias("oldest"), F.max(F.col("scraped_at").isNull()).alias("any_undated"),
        F.count(F.lit(1)).alias("copies"))
    (folded if done is None else not_enriched(folded, done, ["source_id"])).write.parquet(f"{folder}/pending")
    pending = spark.read.schema(_PENDING).parquet(f"{folder}/pending")
    has_id = F.col("source_id").isNotNull()
    totals = pending.agg(
        F.coalesce(F.sum(F.when(~has_id, F.col("copies"))), F.lit(0)).alias("null_ids"),
        F.max(F.when(has_id, F.col("copies"))).alias("most"), F.count("source_id").alias("ids"),
        F.min(F.when(has_id, F.col("oldest"))).alias("oldest"),
        F.max(F.when(has_id, F.col("any_undated"))).alias("any_undated")).first()
    if not totals["most"]:
        return _Selection(None, totals["null_ids"], lambda: 0)
    posts = normalize(source, provider)
    if totals["oldest"] is not None:
        recent = F.col("scraped_at") >= F.lit(totals["oldest"])
        posts = posts.where(recent | F.col("scraped_at").isNull() if totals["any_undated"] else recent)
    rows = Observation()
    posts = posts.join(pending.where(has_id).select("source_id"), "source_id", "left_semi").select(*S.NORMALIZED.names)
    posts = spread_small(posts, rows=totals["ids"]).observe(rows, F.count(F.lit(1)).alias("n"))
    if totals["most"] > 1:
        posts = dedup_posts(posts, S.KEYS)
    return _Selection(posts, totals["null_ids"], lambda: _observed(rows, "n"))


def run(spark: SparkSession, target, as_of: datetime | None = None,
        source: Callable[[str], DataFrame] | None = None,
        providers: str | Iterable[str] | None = None,
        modules: Mapping[str, bool | str] | Sequence[str] | None = None,
        limit: int | None = 100, backend: ModelBackend | None = None,
        reenrich: bool = False, registry: dict[str, Provider] | None = None,
        rejects: str | None = None, side_by_side: int = 1) -> RunReport:
    """Enrich what is new in each provider; each is its own commit.

    A provider that fails, or has nothing new, is skipped and reported, and the
    others go on. ``limit`` is per provider, newest first; None takes all. Posts that
    do not fit the table are counted and kept in the table at ``rejects``, if given.
    ``side_by_side`` providers run at once, each in a job group and a scheduler pool of its own, which share
    the cluster fairly where ``spark.scheduler.mode`` is FAIR.
    """
    configure(spark)
    as_of = as_of or datetime.now(timezone.utc)
    source = source or spark.table
    chosen, unknown = choose(providers, registry)
    on, off = switched_on(modules)
    report = RunReport(unknown_providers=unknown, modules_off=off)
    target.create()

    def enriched(name: str, provider: Provider) -> ProviderReport:
        context = spark.sparkContext
        context.setJobGroup(f"postlume-{name}", f"enrich {name}")
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return enrich_new(source(provider.table), provider, target, on, as_of, limit, backend, reenrich, rejects)
        except Exception as error:  # one broken source must not stop the others
            return ProviderReport(skipped=f"{type(error).__name__}: {error}")
        finally:
            context.setLocalProperty("spark.scheduler.pool", None)
            context.setLocalProperty("spark.jobGroup.id", None)

    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        # A thread of the driver has properties of its own; these start from those of the caller.
        runs = {name: pool.submit(inheritable_thread_target(spark)(enriched), name, provider)
                for name, provider in chosen.items()}
        report.providers = {name: run.result() for name, run in runs.items()}
    return report


def enrich_new(source: DataFrame, provider: Provider, target, modules: Sequence[Module],
               as_of: datetime, limit: int | None = None, backend: ModelBackend | None = None,
               reenrich: bool = False, rejects: str | None = None) -> ProviderReport:
    """Enrich what is new in one source and commit it."""
    spark = source.sparkSession
    scratch = f"{shared_dir(spark)}/postlume-run-{uuid.uuid4().hex}"
    try:
        return _enrich_new(spark, scratch, source, provider, target, modules, as_of, limit,
                           backend, reenrich, rejects)
    finally:
        Files(spark, scratch).remove(scratch)


def _enrich_new(spark, scratch, source, provider, target, modules, as_of, limit, backend,
                reenrich, rejects) -> ProviderReport:
    done, version = None, None
    if not reenrich and not target.is_empty():
        version = target.version()
        done = target.read(version).where(F.col("source_table") == provider.table).select("source_id")

    if limit is None:
        selection = select_all(source, provider, done, scratch)
    else:
        selection = select_newest(source, provider, done, limit, scratch)
    if selection.posts is None:
        return ProviderReport(null_ids=selection.null_ids, skipped="nothing new")
    posts, annotate = selection.posts, annotate_by_rules
    if backend:
        posts.write.parquet(f"{scratch}/posts")
        posts = spark.read.schema(S.NORMALIZED).parquet(f"{scratch}/posts")
        annotate = partial(annotate_by_model, backend=backend, staging=f"{scratch}/answered")
    enriched = enrich(posts, modules, as_of, annotate, day_only=day_only(source, provider.posted_at))
    good, rejected = separate(enriched, target_schema(), S.KEYS, f"{scratch}/checked", rejects)
    # None of the selected keys is in the version they were selected against.
    outcome = target.upsert(good, absent_at=version)
    report = ProviderReport(selection.fetched(), selection.null_ids, rejected=rejected(),
                            inserted=outcome.inserted, updated=outcome.updated)
    if not report.fetched:
        return ProviderReport(null_ids=selection.null_ids, skipped="nothing new")
    if outcome.inserted is not None:
        report.enriched = outcome.inserted + outcome.updated
    tasks = [m.task for m in modules if m.task]
    if backend and tasks:
        counted = status_counts(spark.read.parquet(f"{scratch}/answered"), tasks)
        report.statuses = {(r["task"], r["status"]): r["n"] for r in counted.collect()}
    return report


def run_statistics(selected: DataFrame, written: DataFrame) -> DataFrame:
    """Rows selected, rows dropped as they have no id, and rows written, per source table."""
    a = selected.groupBy("source_table").agg(
        F.count("source_id").alias("fetched"), F.count_if(F.col("source_id").isNull()).alias("null_ids"))
    b = written.groupBy("source_table").agg(F.count(F.lit(1)).alias("written"))
    return a.join(b, "source_table", "left").select(
        "source_table", "fetched", "null_ids", F.coalesce("written", F.lit(0)).alias("written"))
