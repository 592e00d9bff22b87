"""Schemas, vocabularies and default values of the enrichment tables."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names, types and order of the target table, and the
# vocabularies of the annotation answers.
# ---------------------------------------------------------------------------

SOURCE_FIELDS = """
    source_table STRING, source_id STRING, source_text STRING, source_author STRING,
    source_url STRING, keyword STRING, region STRING, scraped_at TIMESTAMP,
    likes BIGINT, shares BIGINT, comments BIGINT, views BIGINT, posted_at TIMESTAMP
"""
LEGACY_SOURCE_FIELDS = """
    tweet_id STRING, tweet_text STRING, author STRING, author_handle STRING,
    likes BIGINT, retweets BIGINT, replies BIGINT, views BIGINT, posted_at TIMESTAMP,
    keyword STRING, region STRING, scraped_at TIMESTAMP
"""
SENTIMENT_FIELDS = """
    sentiment_label STRING, sentiment_score DOUBLE,
    sentiment_emotions ARRAY<STRING>, sentiment_topics ARRAY<STRING>
"""
ENTITY_FIELDS = """
    people ARRAY<STRING>, organizations ARRAY<STRING>, locations ARRAY<STRING>,
    products ARRAY<STRING>, hashtags ARRAY<STRING>, mentions ARRAY<STRING>
"""
TOPIC_FIELDS = """
    primary_category STRING, sub_categories ARRAY<STRING>, industry STRING,
    keywords ARRAY<STRING>, is_commercial BOOLEAN, is_news BOOLEAN
"""
ENGAGEMENT_FIELDS = """
    engagement_score DOUBLE, engagement_rate DOUBLE, virality_score DOUBLE,
    interaction_quality DOUBLE, time_adjusted_score DOUBLE, percentile_score DOUBLE,
    engagement_tier STRING
"""
MODERATION_FIELDS = """
    is_safe BOOLEAN, risk_level STRING, flags ARRAY<STRING>,
    content_warnings ARRAY<STRING>, recommended_action STRING, confidence_score DOUBLE
"""
METADATA_FIELDS = "enriched_at TIMESTAMP, enrichment_version STRING, date DATE"

SENTIMENT_LABELS = ("positive", "negative", "neutral")
CATEGORIES = ("Technology", "Business", "Entertainment", "Sports", "Politics",
              "Health", "Science", "Lifestyle", "Education", "Other")
RISK_LEVELS = ("safe", "low", "medium", "high", "critical")
FLAGS = ("hate_speech", "violence", "adult_content", "spam", "misinformation",
         "profanity", "harassment")
ACTIONS = ("none", "flag", "review", "remove")

SENTIMENT_DEFAULTS = {"sentiment_label": "neutral", "sentiment_score": 0.0,
                      "sentiment_emotions": [], "sentiment_topics": []}
ENTITY_DEFAULTS = {"people": [], "organizations": [], "locations": [],
                   "products": [], "hashtags": [], "mentions": []}
TOPIC_DEFAULTS = {"primary_category": "Other", "sub_categories": [],
                  "industry": "Unknown", "keywords": [],
                  "is_commercial": False, "is_news": False}
ENGAGEMENT_DEFAULTS = {"engagement_score": 0.0, "engagement_rate": 0.0,
                       "virality_score": 0.0, "interaction_quality": 0.0,
                       "time_adjusted_score": 0.0, "percentile_score": 0.0,
                       "engagement_tier": "Low"}
MODERATION_DEFAULTS = {"is_safe": True, "risk_level": "safe", "flags": [],
                       "content_warnings": [], "recommended_action": "none",
                       "confidence_score": 1.0}

ENRICHMENT_VERSION = "1.0.0"

# ---------------------------------------------------------------------------


_SIMPLE = {"STRING": T.StringType(), "BIGINT": T.LongType(), "DOUBLE": T.DoubleType(),
           "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(),
           "DATE": T.DateType(), "ARRAY<STRING>": T.ArrayType(T.StringType())}


def _parse(ddl: str) -> T.StructType:
    """Read the listings above without needing a running session."""
    fields = (item.split() for item in ddl.split(","))
    return T.StructType([T.StructField(name, _SIMPLE[kind]) for name, kind in fields])


SENTIMENT = _parse(SENTIMENT_FIELDS)
ENTITIES = _parse(ENTITY_FIELDS)
TOPIC = _parse(TOPIC_FIELDS)
ENGAGEMENT = _parse(ENGAGEMENT_FIELDS)
MODERATION = _parse(MODERATION_FIELDS)
METADATA = _parse(METADATA_FIELDS)

NORMALIZED = _parse("""
    source_table STRING, source_id STRING, text STRING, author STRING,
    likes BIGINT, retweets BIGINT, replies BIGINT, views BIGINT, posted_at TIMESTAMP,
    keyword STRING, region STRING, scraped_at TIMESTAMP, source_url STRING
""")

DERIVED = (SENTIMENT_FIELDS, ENTITY_FIELDS, TOPIC_FIELDS, ENGAGEMENT_FIELDS,
           MODERATION_FIELDS, METADATA_FIELDS)
ENRICHMENTS = _parse(", ".join((SOURCE_FIELDS, *DERIVED)))
LEGACY_ENRICHED = _parse(", ".join((LEGACY_SOURCE_FIELDS, *DERIVED)))

KEYS = ("source_table", "source_id")
LEGACY_KEYS = ("tweet_id",)
PARTITION = "date"

# normalised name -> target name
TARGET_NAMES = {"text": "source_text", "author": "source_author",
                "retweets": "shares", "replies": "comments"}
