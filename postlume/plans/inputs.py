"""The given tables as post sources.

No social tables are supplied, so each given table is read as if a crawler had
written it; missing columns are derived from the row itself. These sources have
a registry of their own and leave the package's registry alone.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlume.session import configure
from postlume.sources.providers import Provider

AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)
EPOCH = 1704067200  # 2024-01-01T00:00:00Z

PROVIDERS = {p.table: p for p in (
    Provider("documents", id="doc_id", text="text", author="source", likes="n_chars",
             shares="n_lines", comments="n_sentences", views="n_views",
             posted_at="posted_at", region="lang"),
    Provider("conversations", id="conv_id",
             text="coalesce(title || ' ' || caption, title, caption)", comments="n_turns"),
    Provider("pages", id="page_id", text="title", url="url"),
)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def minutes_in(column: str) -> Column:
    """One minute per id, from the start of 2024."""
    return F.timestamp_seconds(F.lit(EPOCH) + F.col(column) * 60)


def with_counts(documents: DataFrame) -> DataFrame:
    """Documents with interaction counts taken from their own text."""
    scraped = minutes_in("doc_id")
    return documents.withColumns({
        "n_lines": F.regexp_count(F.col("text"), F.lit("\n")).cast("bigint"),
        "n_sentences": F.regexp_count(F.col("text"), F.lit("[.!?]")).cast("bigint"),
        "n_views": F.col("n_chars") * 20,
        "scraped_at": scraped,
        "posted_at": F.timestamp_micros(F.unix_micros(scraped) - F.col("n_chars") * 1_500_000),
    })


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_counts(table(spark, sf_dir, "documents"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation: first user turn as title, first answer as caption."""
    turns = table(spark, sf_dir, "conversations")

    def first(role: str) -> Column:
        return F.min_by("text", F.when(F.col("role") == role, F.col("turn")))

    return turns.groupBy("conv_id").agg(
        first("user").alias("title"), first("assistant").alias("caption"),
        F.count(F.lit(1)).alias("n_turns"),
    ).withColumn("scraped_at", minutes_in("conv_id"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id", "url", title.alias("title"), minutes_in("page_id").alias("scraped_at"))


def events_as_crawled(spark: SparkSession, sf_dir: str, provider: Provider) -> DataFrame:
    """Events in the columns that a crawler's table has; a caption only, a title only, both or neither."""
    kind, ts = F.col("event_type"), F.col("ts").cast("timestamp")

    def count(kind_of: str) -> Column:
        return F.when(kind == kind_of, F.floor("value").cast("bigint"))

    columns = {provider.id: F.col("event_id"), "scraped_at": ts}
    if provider.table == "reddit_posts":
        columns |= {"title": F.when(kind.isin("click", "view"), F.col("props")), "caption": F.when(kind.isin("view", "signup"), kind)}
    else:
        columns[provider.text] = F.when(kind != "error", F.col("props"))
    for name, value in ((provider.author, F.concat(F.lit("u"), "user_id")), (provider.likes, count("click")),
                        (provider.shares, count("purchase").cast("string")), (provider.comments, count("signup")),
                        (provider.views, count("view")), (provider.posted_at, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
                        (provider.keyword, kind), (provider.region, F.nullif(kind, F.lit("view")))):
        if name:
            columns[name] = value
    return table(spark, sf_dir, "events").select(*[value.alias(name) for name, value in columns.items()])


SOURCES = {"documents": documents, "conversations": conversations, "pages": pages}


def _per_user_day(spark: SparkSession, sf_dir: str, amount: Column) -> DataFrame:
    def total(kind: str) -> Column:
        summed = F.sum(F.when(F.col("event_type") == kind, amount))
        return F.coalesce(F.floor(summed), F.lit(0)).cast("bigint")

    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        total("click").alias("likes"), total("purchase").alias("retweets"),
        total("signup").alias("replies"), total("view").alias("views"),
        F.min("ts").alias("posted_at"))


def events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user and day: how many events of each kind, as interaction counts."""
    return _per_user_day(spark, sf_dir, F.lit(1))


def events_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by value; summed as decimals, so that no order of summation shows."""
    return _per_user_day(spark, sf_dir, F.col("value").cast("decimal(18,2)"))


def events_as_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of the legacy tweet table; errors have no text."""
    ts = F.col("ts").cast("timestamp")
    kind = F.col("event_type")

    def when(name: str) -> Column:
        return F.when(kind == name, F.floor("value").cast("bigint"))

    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("tweet_id"),
        F.when(kind != "error", F.col("props")).alias("tweet_text"),
        F.concat(F.lit("user "), F.col("user_id")).alias("author"),
        F.concat(F.lit("u"), F.col("user_id")).alias("author_handle"),
        when("click").alias("likes"), when("purchase").alias("retweets"),
        when("signup").alias("replies"), when("view").alias("views"),
        ts.alias("posted_at"), kind.alias("keyword"), F.lit("").alias("region"),
        ts.alias("scraped_at"), F.to_date(ts).alias("date"))
