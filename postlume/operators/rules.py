"""Rule backend: the four text annotations from fixed word lists.

Everything happens inside the row: the text is cut into words once, the words
are reduced to the few that any list knows, and the columns follow from those.
No row is exploded, joined or shuffled, whatever the length of its text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlume import schema as S
from postlume.functions import text as X
from postlume.functions.rounding import round_exact
from postlume.operators import lexicons as L

_STRINGS = "array<string>"


def _count(vocabulary: Iterable[str]) -> Column:
    return F.size(X.keep("_hits", vocabulary))


def _any(vocabulary: Iterable[str]) -> str:
    return f"arrays_overlap(_hits, array({X.quoted(vocabulary)}))"


def _names_hit(groups: Mapping[str, Iterable[str]]) -> str:
    """Sorted names of the groups that have a word among the hits."""
    found = ", ".join(f"CASE WHEN {_any(vocabulary)} THEN '{name}' END"
                      for name, vocabulary in sorted(groups.items()))
    return f"array_compact(array({found}))"


def _sentiment(df: DataFrame, text: str) -> DataFrame:
    emotions = {name: L.words(listed) for name, listed in
                {**L.POSITIVE_EMOTIONS, **L.NEGATIVE_EMOTIONS}.items()}
    long_words = F.expr("filter(_words, word -> length(word) >= 5 AND word NOT IN "
                        f"({X.quoted(L.words(L.STOP_WORDS))}))")
    df = df.withColumns({"_pos": _count(L.POSITIVE), "_neg": _count(L.NEGATIVE)})
    df = X.with_most_frequent(df, long_words, 3, "sentiment_topics")
    df = df.withColumn("_balance", F.expr(
        "CASE WHEN _pos + _neg > 0 THEN abs(_pos - _neg) / (_pos + _neg) ELSE 0D END"))
    return df.withColumns({
        "sentiment_label": F.expr("CASE WHEN _pos > _neg THEN 'positive' "
                                  "WHEN _neg > _pos THEN 'negative' ELSE 'neutral' END"),
        "sentiment_score": round_exact("_balance", 4),
        "sentiment_emotions": F.expr(_names_hit(emotions)),
    }).drop("_pos", "_neg", "_balance")


_PHRASE_STARTS = sorted({phrase.split()[0] for listed in L.GAZETTEER.values() for phrase in listed})


def _entities(df: DataFrame, text: str) -> DataFrame:
    # Few texts hold the first word of any phrase; only those are cut into phrases.
    begun = F.expr(_any(_PHRASE_STARTS))
    df = df.withColumn("_phrases", F.when(begun, X.phrases("_words", _PHRASE_STARTS))
                       .otherwise(F.array().cast(_STRINGS)))
    columns = {name: X.keep("_phrases", phrases) for name, phrases in L.GAZETTEER.items()}
    return df.withColumns({
        **columns,
        "hashtags": X.hashtags(F.col(text)),
        "mentions": X.mentions(F.col(text)),
    }).drop("_phrases")


def _topic(df: DataFrame, text: str) -> DataFrame:
    counts = {c: f"_n_{c}" for c in L.TOPIC_WORDS}
    df = df.withColumns({counts[c]: _count(listed) for c, listed in L.TOPIC_WORDS.items()})
    most = f"greatest({', '.join(counts.values())})"
    ladder = " ".join(f"WHEN {counts[c]} = {most} THEN '{c}'" for c in S.CATEGORIES if c in counts)
    df = df.withColumn("primary_category", F.expr(
        f"CASE WHEN {most} = 0 THEN 'Other' {ladder} END")).drop(*counts.values())

    subs = " ".join(
        f"WHEN '{name}' THEN " + _names_hit({sub: L.words(w) for sub, w in listed.items()})
        for name, listed in L.TOPICS.items())
    industry = " ".join(f"WHEN '{name}' THEN '{label}'" for name, label in L.INDUSTRIES.items())
    all_words = L.words(*[" ".join(listed) for listed in L.TOPIC_WORDS.values()])
    return df.withColumns({
        "sub_categories": F.expr(
            f"CASE primary_category {subs} ELSE CAST(array() AS {_STRINGS}) END"),
        "industry": F.expr(f"CASE primary_category {industry} END"),
        "keywords": F.sort_array(F.array_distinct(X.keep("_hits", all_words))),
        "is_commercial": F.expr(_any(L.words(L.COMMERCIAL))),
        "is_news": F.expr(_any(L.words(L.NEWS))),
    })


def _moderation(df: DataFrame, text: str) -> DataFrame:
    flags = {name: L.words(listed) for name, listed in L.MODERATION.items()}
    warnings = ", ".join(f"CASE WHEN {_any(flags[name])} THEN '{warning}' END"
                         for name, warning in sorted(L.WARNINGS.items(), key=lambda item: item[1]))
    df = df.withColumn("_n", _count(L.words(*L.MODERATION.values())))
    df = df.withColumn("_sure", F.expr("CASE WHEN _n = 0 THEN 1D ELSE _n / (_n + 1) END"))
    return df.withColumns({
        "is_safe": F.expr("_n = 0"),
        "risk_level": F.expr("CASE WHEN _n = 0 THEN 'safe' WHEN _n = 1 THEN 'low' WHEN _n = 2 "
                             "THEN 'medium' WHEN _n <= 4 THEN 'high' ELSE 'critical' END"),
        "flags": F.expr(_names_hit(flags)),
        "content_warnings": F.expr(f"array_compact(array({warnings}))"),
        "recommended_action": F.expr("CASE WHEN _n = 0 THEN 'none' WHEN _n = 1 THEN 'flag' "
                                     "WHEN _n <= 4 THEN 'review' ELSE 'remove' END"),
        "confidence_score": round_exact("_sure", 4),
    }).drop("_n", "_sure")


_RULES = {"sentiment": _sentiment, "entities": _entities, "topic": _topic,
          "moderation": _moderation}
_VOCABULARY = {
    "sentiment": L.words(" ".join(L.POSITIVE), " ".join(L.NEGATIVE)),
    "entities": _PHRASE_STARTS,
    "topic": L.words(*[" ".join(listed) for listed in L.TOPIC_WORDS.values()],
                     L.COMMERCIAL, L.NEWS),
    "moderation": L.words(*L.MODERATION.values()),
}


def register_rule(task: str, rule: Callable[[DataFrame, str], DataFrame],
                  vocabulary: Iterable[str] = ()) -> None:
    """Let the rule backend answer a task: ``rule(df, text)`` adds its columns. It finds the words of
    the text in ``_words`` and those that are in ``vocabulary`` in ``_hits``."""
    _RULES[task] = rule
    _VOCABULARY[task] = set(vocabulary)


def annotate_by_rules(df: DataFrame, tasks: Iterable[str], text: str = "text") -> DataFrame:
    """Add the columns of the named tasks. A blank text gets the defaults: it has
    no words, and every rule maps no words to its default."""
    asked = set(tasks)
    if unknown := sorted(asked - set(_RULES)):
        raise ValueError(f"no rules for the tasks {unknown}; register_rule adds one")
    tasks = [name for name in _RULES if name in asked]
    if not tasks:
        return df
    df = df.withColumn("_words", X.tokens(F.coalesce(F.col(text), F.lit(""))))
    vocabulary = sorted({word for name in tasks for word in _VOCABULARY[name]})
    df = df.withColumn("_hits", X.keep("_words", vocabulary))
    for name in tasks:
        df = _RULES[name](df, text)
    return df.drop("_words", "_hits")
