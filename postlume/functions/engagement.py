"""Engagement metrics of a post as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlume.functions.rounding import round_exact
from postlume.functions.timestamps import instant

# The weight of each interaction, the scale of the percentile and
# the lower bound of every tier.
WEIGHTS = {"likes": 1.0, "retweets": 3.0, "replies": 2.0, "views": 0.01}
PERCENTILE_PER_DECADE = 25.0
PERCENTILE_CAP = 100.0
TIERS = ((90, "Viral"), (75, "High"), (50, "Above Average"), (25, "Average"),
         (10, "Below Average"))
LOWEST_TIER = "Low"

COUNTS = ("likes", "retweets", "replies", "views")


def weighted_score(weights: Mapping[str, float] = WEIGHTS) -> str:
    return " + ".join(f"_{name} * {float(weights[name])!r}D" for name in COUNTS)


def ratio(numerator: str, denominator: str) -> str:
    """0.0 unless the denominator is positive."""
    return f"CASE WHEN {denominator} > 0 THEN ({numerator}) / ({denominator}) ELSE 0D END"


def percentile(score: str) -> str:
    scaled = f"least({PERCENTILE_CAP!r}D, log10({score} + 1D) * {PERCENTILE_PER_DECADE!r}D)"
    return f"CASE WHEN {score} > 0 THEN {scaled} ELSE 0D END"


def tier(unrounded_percentile: str) -> str:
    steps = " ".join(f"WHEN {unrounded_percentile} >= {bound} THEN '{name}'"
                     for bound, name in TIERS)
    return f"CASE {steps} ELSE '{LOWEST_TIER}' END"


def with_engagement(df: DataFrame, as_of: datetime,
                    weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """Add the seven engagement columns.

    Reads ``likes``, ``retweets``, ``replies``, ``views`` (NULL counts as 0) and
    the timestamp ``posted_at``. Each step is a select of its own, so that a
    metric is computed once however often the next step refers to it.
    """
    counts = df.withColumns({
        **{f"_{name}": F.expr(f"coalesce(CAST({name} AS DOUBLE), 0D)") for name in COUNTS},
        "_hours": (F.unix_micros(instant(as_of)) - F.unix_micros("posted_at"))
        / F.lit(1e6) / F.lit(3600.0),
    })
    interactions = "_likes + _retweets + _replies"
    raw = counts.withColumns({
        "_score": F.expr(weighted_score(weights)),
        "_rate": F.expr(ratio(interactions, "_views")),
        "_virality": F.expr(ratio("_retweets", interactions)),
        "_quality": F.expr(ratio("_replies + _retweets", "_likes")),
    }).withColumns({
        "_hourly": F.expr(ratio("_score", "_hours")),
        "_percentile": F.expr(percentile("_score")),
    })
    return raw.withColumns({
        "engagement_score": round_exact("_score", 2),
        "engagement_rate": round_exact("_rate", 4),
        "virality_score": round_exact("_virality", 4),
        "interaction_quality": round_exact("_quality", 4),
        "time_adjusted_score": round_exact("_hourly", 2),
        "percentile_score": round_exact("_percentile", 2),
        "engagement_tier": F.expr(tier("_percentile")),
    }).drop(*[f"_{name}" for name in COUNTS], "_hours", "_score", "_rate", "_virality",
            "_quality", "_hourly", "_percentile")
