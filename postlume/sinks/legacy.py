"""The older, tweet-shaped form of the enriched table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlume import schema as S

# Legacy column -> column of the unified table.
_SAME_VALUE = {"tweet_id": "source_id", "tweet_text": "source_text", "author": "source_author",
               "retweets": "shares", "replies": "comments"}


def as_legacy(enriched: DataFrame, tweets: DataFrame | None = None,
              source_table: str = "x_tweets") -> DataFrame:
    """Rows of one source in the 44-column legacy form.

    ``author_handle`` is not in the unified table: it comes from the source
    table if given, newest scrape per tweet, else it is NULL.
    """
    rows = enriched.where(F.col("source_table") == source_table)
    if tweets is None:
        rows = rows.withColumn("author_handle", F.lit(None).cast("string"))
    else:
        handles = tweets.groupBy(F.col("tweet_id").cast("string").alias("source_id")).agg(
            F.max_by("author_handle", F.coalesce(F.col("scraped_at").cast("timestamp"),
                                                 F.timestamp_micros(F.lit(0)))).alias("author_handle"))
        rows = rows.join(handles, "source_id", "left")
    return rows.select(*[F.col(_SAME_VALUE.get(f.name, f.name)).cast(f.dataType).alias(f.name)
                         for f in S.LEGACY_ENRICHED])
