"""Text predicates and extractors, all on built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Any character that is not white space; \x1c-\x1f count as white space too.
_VISIBLE = r"(?U)[^\s\x1c-\x1f]"
_WORD = r"\p{L}\p{M}\p{N}_"
# The sign comes first and the look-behind after it: most positions fail on one
# character that way.
HASHTAG = rf"#(?<![{_WORD}&/]#)([{_WORD}]+)"
MENTION = rf"@(?<![{_WORD}.@]@)([{_WORD}]+)"
TOKEN = r"\p{L}+"


def is_blank(text: Column) -> Column:
    """NULL, empty, or nothing but white space."""
    return text.isNull() | ~text.rlike(_VISIBLE)


def _marked(text: Column, sign: str, pattern: str) -> Column:
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
    return F.when(F.contains(text, F.lit(sign)), found).otherwise(F.array().cast("array<string>"))


def hashtags(text: Column) -> Column:
    """Tags without the ``#``, distinct, in order of appearance."""
    return _marked(text, "#", HASHTAG)


def mentions(text: Column) -> Column:
    """User names without the ``@``; the host of an e-mail address is none."""
    return _marked(text, "@", MENTION)


def tokens(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def quoted(words: Iterable[str]) -> str:
    """The words as a list of SQL literals."""
    return ", ".join("'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"
                     for word in sorted(words))


def keep(name: str, vocabulary: Iterable[str]) -> Column:
    """The elements of the array column found in ``vocabulary``, repeats kept.

    ``IN`` with more than a handful of literals becomes a hash set, so this is
    one pass over the array however long the vocabulary is.
    """
    return F.expr(f"filter({name}, word -> word IN ({quoted(vocabulary)}))")


def with_most_frequent(df: DataFrame, words: Column, k: int, name: str) -> DataFrame:
    """Add the ``k`` words with the highest counts, ties in alphabetical order.

    The sorted words are cut where one differs from the word before it, which
    takes one pass; counting each distinct word would take one pass per word.
    Every step is a column of its own and is used at least twice by the next:
    Catalyst inlines what is used once, also into a lambda that runs per element.
    """
    df = df.withColumn("_sorted", F.sort_array(words))
    df = df.withColumn("_starts", F.expr("""
        filter(transform(_sorted, (word, i) ->
                   CASE WHEN i = 0 OR word <> get(_sorted, i - 1) THEN i END),
               i -> i IS NOT NULL)"""))
    stops = "concat(slice(_starts, 2, greatest(size(_sorted), 1)), array(size(_sorted)))"
    df = df.withColumn("_spans", F.arrays_zip(F.col("_starts").alias("start"),
                                              F.expr(stops).alias("stop")))
    # Words that occur once matter only if fewer than k occur more often.
    df = df.withColumn("_repeated", F.expr("filter(_spans, s -> s.stop - s.start > 1)"))
    df = df.withColumn(name, F.expr(f"""
        filter(transform(slice(sort_array(transform(
                   CASE WHEN size(_repeated) >= {k} THEN _repeated ELSE _spans END,
                   s -> struct(s.start - s.stop AS rank, get(_sorted, s.start) AS word))), 1, {k}),
                   run -> run.word),
               word -> word IS NOT NULL)"""))
    return df.drop("_sorted", "_starts", "_spans", "_repeated")


def phrases(name: str, first_words: Iterable[str]) -> Column:
    """Distinct one- to three-word phrases that start with one of ``first_words``.

    ``name`` is the column of the words, in order.
    """
    starts = f"""filter(transform({name}, (word, i) ->
                            CASE WHEN word IN ({quoted(first_words)}) THEN i END),
                        i -> i IS NOT NULL)"""
    one, two, three = (f"get({name}, i + {k})" for k in range(3))
    return F.expr(f"""
        array_distinct(array_compact(flatten(transform({starts}, i -> array(
            {one}, {one} || ' ' || {two}, {one} || ' ' || {two} || ' ' || {three})))))""")
