"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a sample of labelled text is built. A text is parsed greedily
into phrases, each the longest that occurs in the sample; a text in the language of the sample needs
few. Phrases times the logarithm of the sample's length, per character, estimate the cross entropy;
the language with the least wins (ties: the first by name).

The sample is bounded: ``sample_rows`` rows for each language, picked by a hash of their id among
those that may be learned from, of at most ``row_chars`` characters each (shorter texts are taken
first, of longer ones the beginning), ``total_bytes`` bytes over all languages. Predictions read whole
texts. Samples and texts are read as UTF-8, so that the machines know every letter of every script with at most 256
symbols. Parsing starts anew every ``STRETCH`` bytes, so that long texts advance side by side; this
adds at most one phrase to a stretch, for each language alike.

Defined cases: texts are compared in lower case, runs of anything but letters as one space; a null
text or one without a letter gives ``und`` with score 0; a null id counts as the empty text in the
split and so is held out; with no labelled rows at all everything is ``und``; a single language wins
with score 1; repeated rows repeat their results. Result columns replace input columns of the same
name. The score is 1 - least / second least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlume.llm.pretokens import END, LETTER, classes
from postlume.llm.spans import pieces, ranges, utf8

STRETCH = 2048
_PHRASE = np.int32(1 << 30)


def _letters(text: str) -> np.ndarray:
    """Code points in lower case, each run of other signs one 0."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    kind = classes()[points]
    points = np.where((kind == LETTER) | (kind > END), points, np.uint32(0))
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] > 0) | (points[:-1] > 0)
    return points[keep]


def _utf8(points: np.ndarray) -> np.ndarray:
    return np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest machine that reads exactly the substrings of ``text``; 0 starts."""
    go, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and c not in go[at]:
            go[at][c] = new
            at = link[at]
        if at >= 0:
            to = go[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(go)
                go.append(dict(go[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at >= 0 and go[at].get(c) == to:
                    go[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return go


class CrossParser:
    """The automata of all languages as one table of next states; the phrase bit says that a phrase
    ended before this byte."""

    def __init__(self, samples: dict[str, list[str]], total_bytes: int):
        self.languages = sorted(samples)
        texts = {}
        for name in self.languages:
            joined = np.concatenate([np.zeros(1, np.uint32), *(x for t in samples[name] for x in (_letters(t), np.zeros(1, np.uint32)))])
            texts[name] = _utf8(joined)[:max(1, total_bytes // len(self.languages))]
        # UTF-8 has 243 different bytes at most; one symbol is for those that no sample holds.
        alphabet = np.unique(np.concatenate([np.zeros(1, np.uint8), *texts.values()]))
        self.symbol = np.full(256, len(alphabet), np.uint8)
        self.symbol[alphabet] = np.arange(len(alphabet))
        width, tables, self.roots, base = len(alphabet) + 1, [], [], 0
        for name in self.languages:
            go = suffix_automaton(self.symbol[texts[name]].tolist())
            table = np.full((len(go), width), -1, np.int32)
            for state, edges in enumerate(go):
                for c, to in edges.items():
                    table[state, c] = base + to
            again = np.where(table[0] >= 0, table[0], base) | _PHRASE
            table = np.where(table >= 0, table, again)
            tables.append(table.astype(np.int32))
            self.roots.append(base)
            base += len(go)
        self.width = width
        self.table = np.concatenate(tables).reshape(-1) if tables else np.zeros(0, np.int32)
        self.weight = np.array([np.log2(max(2, len(texts[n]))) for n in self.languages])

    def entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character for each text and language, and the letters of each text."""
        points = [_letters(t) for t in texts]
        letters = np.array([int((p > 0).sum()) for p in points], np.int64)
        signs = np.array([len(p) for p in points], np.int64)
        coded = [_utf8(p) for p in points]
        length = np.array([len(c) for c in coded], np.int64)
        symbols = self.symbol[np.concatenate([np.zeros(0, np.uint8), *coded])]
        begin = np.cumsum(length) - length
        stretches = -(-length // STRETCH)
        owner = np.repeat(np.arange(len(texts)), stretches)
        nth = ranges(np.zeros(len(texts), np.int64), stretches)
        start = begin[owner] + nth * STRETCH
        size = np.minimum(STRETCH, length[owner] - nth * STRETCH)
        order = np.argsort(-size, kind="stable")
        start, size, owner = start[order], size[order], owner[order]
        alive = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), "left")
        n = len(self.languages)
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(start), axis=1)
        phrases = np.ones((n, len(start)), np.int32)
        for step, lanes in enumerate(alive.tolist()):
            to = self.table[state[:, :lanes] * np.int64(self.width) + symbols[start[:lanes] + step]]
            phrases[:, :lanes] += to >= _PHRASE
            state[:, :lanes] = to & (_PHRASE - 1)
        total = np.stack([np.bincount(owner, phrases[i], len(texts)) for i in range(n)], axis=1) if n else np.zeros((len(texts), 0))
        return total * self.weight / np.maximum(signs, 1)[:, None], letters


def held_out(id: str):
    """Whether a row is kept for testing."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % 5 == 0


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = 48,
          row_chars: int = 4000, total_bytes: int = 64_000) -> CrossParser:
    """The parser, from a bounded sample of the rows that are not held out."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(id))
    ranked = rows.select(F.col(lang).alias("lang"), F.substring(text, 1, row_chars).alias("text"), F.col(id).alias("id"),
                         (F.length(text) > row_chars).alias("long"))
    first = Window.partitionBy("lang").orderBy("long", F.xxhash64("id", F.lit(1)), "id", "text")
    picked = ranked.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= sample_rows)
    samples: dict[str, list[str]] = {}
    for row in sorted(picked.collect(), key=lambda r: (r.lang, r.nth)):  # at most sample_rows x row_chars a language
        samples.setdefault(row.lang, []).append(row.text)
    return CrossParser(samples, total_bytes)


def identify(docs: DataFrame, parser: CrossParser, text: str = "text") -> DataFrame:
    """The input with lang_pred and score; nothing but the text decides."""
    columns = [f for f in docs.schema.fields if f.name.lower() not in ("lang_pred", "score")]
    names = [f.name for f in columns]
    # Only its arrays are sent: a broadcast cannot carry the class to workers without this package.
    sent = docs.sparkSession.sparkContext.broadcast(vars(parser))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = CrossParser.__new__(CrossParser)
        vars(parser).update(sent.value)
        for batch in batches:
            texts = batch.column("_l_text")
            for first, end, _, _ in pieces(*utf8(texts)):
                bits, letters = parser.entropy(texts.slice(first, end - first).to_pylist())
                n = len(parser.languages)
                known = (letters > 0) & (n > 0)
                best = bits.argmin(axis=1) if n else np.zeros(end - first, np.int64)
                if n > 1:
                    least = np.partition(bits, 1, axis=1)
                    score = 1 - least[:, 0] / np.maximum(least[:, 1], 1e-12)
                else:
                    score = np.ones(end - first)
                part = batch.slice(first, end - first)
                yield pa.record_batch(
                    [*(part.column(c) for c in names),
                     pa.array([parser.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())], pa.string()),
                     pa.array(np.where(known, score, 0.0))], [*names, "lang_pred", "score"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in columns) + "lang_pred string, score double"
    return docs.select(*(f"`{c}`" for c in names), F.coalesce(F.col(text), F.lit("")).alias("_l_text")).mapInArrow(run, schema)
