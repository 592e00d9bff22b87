"""From a source table to the common post schema, and the reads on it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlume.functions.timestamps import with_posted_instant
from postlume.sources.providers import Provider

_LEGACY_COLUMNS = ("tweet_id", "tweet_text", "author", "author_handle", "likes", "retweets",
                   "replies", "views", "posted_at", "keyword", "region", "scraped_at")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def source_id(provider: Provider) -> str:
    """The one text form of an id: used to store it and to look it up."""
    return f"CAST({_quoted(provider.id)} AS STRING) AS source_id"


def scraped_at(provider: Provider) -> str:
    """The scrape time; a value that is none is NULL, as a missing one."""
    return f"TRY_CAST({_quoted(provider.scraped_at)} AS TIMESTAMP) AS scraped_at"


def source_keys(source: DataFrame, provider: Provider) -> DataFrame:
    """(source_id, scraped_at) of all rows: selection starts from these, without a text in the scan."""
    return source.selectExpr(source_id(provider), scraped_at(provider))


def normalize(source: DataFrame, provider: Provider) -> DataFrame:
    """Map a source table to the 13 common columns; keeps posts that have a text.

    One select, so only the mapped columns are read. A mapped column the table
    does not have is an analysis error; an unmapped one gets its default.
    """
    def text(column: str | None, name: str) -> str:
        value = f"coalesce(CAST({_quoted(column)} AS STRING), '')" if column else "''"
        return f"{value} AS {name}"

    def count(column: str | None, name: str) -> str:
        # Text such as '12.7' is a number too: its fraction is cut, as that of a DOUBLE is.
        value = (f"coalesce(TRY_CAST({_quoted(column)} AS BIGINT), TRY_CAST(TRY_CAST(CAST({_quoted(column)} AS STRING) "
                 "AS DECIMAL(38, 6)) AS BIGINT), 0L)") if column else "0L"
        return f"{value} AS {name}"

    present = source.where(f"({provider.text}) IS NOT NULL")
    posted = "CAST(NULL AS TIMESTAMP)"
    if provider.posted_at:
        posted = "_posted"
        present = with_posted_instant(present, _quoted(provider.posted_at), posted)
    table = provider.table.replace("'", "\\'")
    return present.selectExpr(
        f"'{table}' AS source_table",
        source_id(provider),
        f"{provider.text} AS text",
        text(provider.author, "author"),
        count(provider.likes, "likes"),
        count(provider.shares, "retweets"),
        count(provider.comments, "replies"),
        count(provider.views, "views"),
        f"{posted} AS posted_at",
        text(provider.keyword, "keyword"),
        text(provider.region, "region"),
        scraped_at(provider),
        text(provider.url, "source_url"))


def newest(posts: DataFrame, by: str, tie: str, limit: int | None) -> DataFrame:
    """Newest first, ties by ``tie``. With a limit every task keeps its own top
    ``limit`` rows and only those meet."""
    ordered = posts.orderBy(F.col(by).desc_nulls_last(), F.col(tie).asc())
    return ordered if limit is None else ordered.limit(limit)


def latest_tweets(tweets: DataFrame, limit: int = 100) -> DataFrame:
    """The legacy read: twelve columns, newest first; enriched ones included."""
    return newest(tweets.where(F.col("tweet_text").isNotNull()).select(*_LEGACY_COLUMNS),
                  "scraped_at", "tweet_id", limit)


def tweets_between(tweets: DataFrame, start: date, end: date, limit: int = 1000) -> DataFrame:
    """The legacy read of the days ``start`` to ``end``, both included.

    On a table partitioned by ``date`` only those partitions are listed and read.
    """
    days = tweets.where(F.col("date").between(F.lit(start), F.lit(end)))
    return latest_tweets(days, limit)
