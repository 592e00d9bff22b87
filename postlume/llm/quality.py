"""Quality rules: lines are judged first, documents by what is left of them.

Everything here is DataFrame code on one row at a time: no shuffle, no Python on the executors.

Rules for a line that has a word:

* punctuation: it ends in a terminal mark (closing quotes and brackets may follow), and at most
  ``max_marked`` of its words carry symbols or doubled marks;
* navigation: it has fewer than ``min_separators`` words that are bare separators, or these are at
  most ``max_separators`` of its words;
* boilerplate: phrases below and curly braces are few, one in more than ``boilerplate_words`` words; so they
  condemn a short line, and not a paragraph that mentions one.

A line that fails one of them is removed. A document is rejected if it fails the base rules (fewer
than ``min_words`` words, or more than ``max_repeat`` of its words in 8-word windows that it holds
twice or more) or if the removed lines held more than ``max_loss`` of its words.

Defined cases: a null text counts as empty; an empty text has no words and fails the base rules;
rows are judged one by one, so repeated rows and repeated ids all get the same verdict; an empty
table gives an empty result. Columns of the input with the name of a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What divides words, what counts as a symbol.
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
NOT_SYMBOLS = r"[^#*$%&|<>]+"

TERMINAL = (r"[.!?…:;。！？：；।॥؟۔؛።։។။][\"'”’»)\]」』）】》〉]*[\x20\x09-\x0D]*\z")
MARKED = r"[#*$%&|<>~^=_]|[!?]{2,}"
SEPARATOR = r"^[|>»•·/\\-]+$"
SEPARATORS = r"[|>»•·/\\-]"
BOILERPLATE = (r"(?i)\b(?:cookies?|javascript|lorem ipsum|all rights reserved|terms of (?:use|service)|"
               r"privacy policy|click here|log ?in|sign ?up|subscribe now|share this|read more|skip to content|"
               r"back to top|powered by)\b|[{}]")
WINDOW = 8

RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "n_removed_words", "clean_text", "kept")


def _words(text: str) -> str:
    return f"array_remove(split({text}, r'{GAP}'), '')"


def _repeated_words() -> tuple[Column, Column, Column]:
    """Words inside windows found twice or more. Hashes tell which rows have such windows at all;
    in these rows the windows themselves are compared."""
    order = F.expr(
        "sort_array(transform(sequence(0, size(_q_words) - 8), p -> struct("
        "array_join(slice(_q_words, p + 1, 8), ' ') as t, p as p)))")
    found = F.expr(
        "sort_array(filter(transform(_q_order, (x, j) -> if(x.t = get(_q_order, j - 1).t "
        "or x.t = get(_q_order, j + 1).t, x.p, null)), p -> p is not null))")
    covered = F.expr(
        "aggregate(_q_found, struct(-8 as last, 0L as n), (a, p) -> struct(p as last, "
        "a.n + cast(least(8, p - a.last) as bigint) as n), a -> a.n)")
    return order, found, covered


def quality_rules(docs: DataFrame, text: str = "text", min_words: int = 20, max_repeat: float = 0.3,
                  max_marked: float = 1 / 3, min_separators: int = 2, max_separators: float = 0.1,
                  max_loss: float = 0.3, boilerplate_words: int = 20) -> DataFrame:
    """The input with the columns of ``RESULTS``: the figures, the text without its bad lines, and
    the verdict."""
    kept_columns = [f"`{c}`" for c in docs.columns if c.lower() not in RESULTS]
    order, found, covered = _repeated_words()
    hashes = ", ".join(f"get(_q_hash, p + {k})" for k in range(WINDOW))
    frame = (
        docs.select(*kept_columns, F.coalesce(F.col(text), F.lit("")).alias("_q_text"),
                    F.lit(TERMINAL).alias("_q_terminal"))
        .withColumn("_q_words", F.expr(_words("_q_text")))
        .withColumn("_q_lines", F.expr(
            f"filter(split(_q_text, '\n', -1), x -> x rlike r'{WORD}')"))
        .withColumn("_q_hash", F.expr("transform(_q_words, w -> xxhash64(w))"))
        .withColumn("_q_windows", F.expr(
            f"if(size(_q_words) < {WINDOW}, array(), "
            f"transform(sequence(0, size(_q_words) - {WINDOW}), p -> xxhash64({hashes})))"))
        .withColumn("_q_again", F.expr("size(array_distinct(_q_windows)) < size(_q_windows)"))
        .withColumn("_q_order", F.when(F.col("_q_again"), order))
        .withColumn("_q_found", F.when(F.col("_q_again"), found))
        .withColumn("n_repeat_words", F.coalesce(F.when(F.col("_q_again"), covered), F.lit(0).cast("bigint")))
        .withColumn("_q_judged", F.expr(
            "transform(_q_lines, x -> named_struct('x', x, 'w', " + _words("x") + "))"))
        .withColumn("_q_judged", F.expr(
            "transform(_q_judged, l -> named_struct('x', l.x, 'n', size(l.w), 'ok', "
            "regexp_like(l.x, _q_terminal)"
            f" and (not l.x rlike r'{MARKED}'"
            f" or size(filter(l.w, w -> w rlike r'{MARKED}')) <= {max_marked!r}D * size(l.w))"
            f" and (not l.x rlike r'{SEPARATORS}'"
            f" or size(filter(l.w, w -> w rlike r'{SEPARATOR}')) < {int(min_separators)}"
            f" or size(filter(l.w, w -> w rlike r'{SEPARATOR}')) <= {max_separators!r}D * size(l.w))"
            f" and (not l.x rlike r'{BOILERPLATE}'"
            f" or {int(boilerplate_words)} * regexp_count(l.x, r'{BOILERPLATE}') < size(l.w))))"))
    )
    # The row number times nothing keeps a filter on the results from being pushed below them: there it
    # would spell out every step of the figures, each as often as it is used.
    n_words = F.size("_q_words").cast("bigint") + F.monotonically_increasing_id() * 0
    lost = F.expr("aggregate(_q_judged, 0L, (a, l) -> a + if(l.ok, 0, l.n))")
    return (
        frame.select(
            *kept_columns, n_words.alias("n_words"),
            F.expr("cast(char_length(concat_ws('', _q_words)) as bigint)").alias("word_chars"),
            F.expr(f"cast(char_length(regexp_replace(_q_text, r'{NOT_SYMBOLS}', '')) as bigint)").alias("n_symbols"),
            F.expr("cast(size(_q_lines) - size(array_distinct(_q_lines)) as bigint)").alias("n_dup_lines"),
            "n_repeat_words", lost.alias("n_removed_words"),
            F.expr("array_join(transform(filter(_q_judged, l -> l.ok), l -> l.x), '\n')").alias("clean_text"))
        .withColumn("base_failed", (F.col("n_words") < min_words)
                    | (100 * F.col("n_repeat_words") > 100 * max_repeat * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed")
                    & (F.col("n_removed_words") <= max_loss * F.col("n_words")))
    )
