"""Benchmark decontamination by templates.

Both sides are brought to a template: words in lower case without outer punctuation, where numbers,
names and units stand as typed placeholders. A number is a word with a digit or one of
``NUMBER_WORDS``; a unit is one of ``UNITS`` right after a number; a name is a word with a capital and a
small letter after it that does not open a sentence, a line or the text, and neighbouring names are one slot. Windows of
``WINDOW`` template words are joined by hash; items of fewer words are one window of their own
length. Windows with more placeholders than words are joined by the values of their slots instead, as
their template alone says too little. A bitmap of fixed size, made from the items, keeps all other windows of the documents out of
the shuffle.

Whether a word is a name depends on its case and on where lines break, so every window comes in two forms: with names
as placeholders, and with all words as they are in lower case. The first finds an item with other names, the second one that was
copied in capitals, in lower case or with other line breaks.

A document is contaminated by an item if, in one of the forms, windows of both cover in step, without a gap, at least
``min_words`` template words and the slots in step are consistent: one value of the item is always the same value
of the document, and the other way round. So a question with other numbers or names is found, and
one that only looks alike is not. Of a shorter item all words are asked for, or all but one from
``WINDOW`` + 1 words on, as its first word may be read as a name in the middle of a sentence.

Defined cases: null texts count as empty; items of fewer than ``SHORTEST`` words are left out; an item or a document with a null id is judged like the
others and keeps its null; rows that repeat a document's id are told apart by their text; repeated
items each give a row; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlume.llm.spans import LETTERS_ONLY, mix, pieces, span_hash, utf8, window_hash, word_spans

WINDOW = 8
FORMS = 2
SHORTEST = 3
LOG2_BITS = 26
BLOCK = 1 << 16

NUMBER_WORDS = ("two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred "
                "thousand million billion dozen").split()
UNITS = ("km m cm mm mi mile miles meter meters metre metres foot feet inch inches yard yards kg g mg gram grams "
         "pound pounds ounce ounces ton tons tonne tonnes l ml liter liters litre litres gallon gallons s sec second "
         "seconds min minute minutes h hr hour hours day days week weeks month months year years dollar dollars "
         "euro euros cent cents percent degree degrees mph kmh watt watts volt volts joule joules newton newtons "
         "byte bytes kb mb gb tb hz khz mhz ghz").split()


def _hashes(words: list[str]) -> np.ndarray:
    data, offsets = utf8(pa.array(words))
    return np.sort(span_hash(data, offsets[:-1], offsets[1:]))


def _templates(original: pa.Array) -> Iterator[tuple]:
    """By piece: first text, number of texts, and for both forms token hashes, slot values (0: a plain word) and the
    text of each token."""
    numbers, units = _hashes(NUMBER_WORDS), _hashes(UNITS)
    marks = {kind: mix(np.array([kind], np.uint64))[0] for kind in (1, 2, 3)}
    capital = np.zeros(256, bool)
    capital[65:91] = True
    closing = np.zeros(256, bool)
    closing[[ord(c) for c in ".!?:"]] = True
    digit = np.zeros(256, bool)
    digit[48:58] = True
    data_all, offsets_all = utf8(original)
    low_all, low_offsets = utf8(pc.utf8_lower(original))
    for first, end, data, offsets in pieces(data_all, offsets_all):
        low = low_all[low_offsets[first]:low_offsets[end]]
        starts, ends, doc = word_spans(data, offsets)
        low_starts, low_ends, _ = word_spans(low, low_offsets[first:end + 1] - low_offsets[first])
        n = len(starts)
        if not n:
            yield first, end - first, [(np.zeros(0, np.uint64), np.zeros(0, np.uint64), doc)] * FORMS
            continue

        def core(text: np.ndarray, a: np.ndarray, b: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.arange(len(text))
            following = np.minimum.accumulate(np.where(inner, at, len(text))[::-1])[::-1]
            before = np.maximum.accumulate(np.where(inner, at, -1))
            return following[a], before[b - 1] + 1

        # Cores: from the first to the last letter or digit of a word.
        plain = ~LETTERS_ONLY
        low_a, low_b = core(low, low_starts, low_ends, plain[low])
        a, _ = core(data, starts, ends, plain[data] | capital[data])
        solid = low_a < low_b
        low_a, low_b = np.where(solid, low_a, low_starts), np.where(solid, low_b, low_starts + 1)
        value = span_hash(low, low_a, low_b)
        digits = np.concatenate([[0], np.cumsum(digit[low])])
        is_number = (digits[low_b] > digits[low_a]) | np.isin(value, numbers)
        is_unit = np.zeros(n, bool)
        is_unit[1:] = is_number[:-1] & np.isin(value[1:], units) & (doc[1:] == doc[:-1])
        a = np.minimum(a, len(data) - 1)
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        second = padded[a + 1]
        wide = (data[a] == 0xC3) & (second >= 0x80) & (second <= 0x9E)
        # A small letter must follow: a word all in capitals is no name.
        c, d = padded[a + 1 + wide], padded[a + 2 + wide]
        big = (capital[data[a]] | wide) & (((c >= 97) & (c < 123)) | ((c == 0xC3) & (d > 0x9E)))
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        opens = np.ones(n, bool)
        opens[1:] = closing[data[ends[:-1] - 1]] | (doc[1:] != doc[:-1]) | (lines[starts[1:]] > lines[starts[:-1]])
        is_name = big & ~opens & ~is_number & ~is_unit
        kind = np.where(is_number, 1, np.where(is_unit, 2, np.where(is_name, 3, 0)))
        token = value.copy()
        for k, mark in marks.items():
            token[kind == k] = mark
        slot = np.where(kind > 0, value | np.uint64(1), np.uint64(0))
        # Runs of names are one slot, with the value of the last one: the first may be a common word that
        # opened a sentence elsewhere.
        tail = np.zeros(n, bool)
        tail[1:] = is_name[1:] & is_name[:-1] & (doc[1:] == doc[:-1])
        last = np.ones(n, bool)
        last[:-1] = ~tail[1:]
        keep = solid & last
        named = is_name & solid
        lower = np.where(named, value, token), np.where(named, np.uint64(0), slot), doc
        yield first, end - first, [(token[keep], slot[keep], doc[keep]), tuple(x[solid] for x in lower)]


def _windows(tokens: np.ndarray, slots: np.ndarray, doc: np.ndarray, k: int, form: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of one text each; those of few plain words by their values."""
    if len(tokens) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = mix(window_hash(tokens, k) + np.uint64(k + (form << 8)))
    plain = np.concatenate([[0], np.cumsum(slots == 0)])
    few = 2 * (plain[k:] - plain[:-k]) < k
    if few.any():
        exact = mix(window_hash(np.where(slots > 0, mix(slots), tokens), k) + np.uint64(WINDOW + k + (form << 8)))
        hashes = np.where(few, exact, hashes)
    at = np.flatnonzero(doc[:len(hashes)] == doc[k - 1:])
    return at, hashes[at]


def _cell(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - LOG2_BITS)


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("item_id")
        rows = []
        for first, n, forms in _templates(batch.column("text")):
            for form, (tokens, slots, doc) in enumerate(forms):
                edge = np.searchsorted(doc, np.arange(n + 1))
                size = np.diff(edge)
                for k in range(SHORTEST, WINDOW + 1):
                    at, hashes = _windows(tokens, slots, doc, k, form)
                    for i, h in zip(at.tolist(), hashes.tolist()):
                        d = doc[i]
                        if size[d] == k or (k == WINDOW and size[d] > k):
                            rows.append((first + d, h, i - edge[d], size[d], k, slots[i:i + k].view(np.int64).tolist(), form))
        owner, hashes, place, size, k, slot, form = zip(*rows) if rows else ([],) * 7
        yield pa.record_batch(
            [pa.array(np.array(hashes, np.uint64).view(np.int64)), ids.take(pa.array(owner, pa.int64())),
             pa.array(place, pa.int32()), pa.array(size, pa.int32()), pa.array(k, pa.int32()), pa.array(slot, pa.list_(pa.int64())),
             pa.array(owner, pa.int64()), pa.array(form, pa.int32())],
            ["hash", "item_id", "item_at", "item_words", "k", "item_slots", "row", "form"])


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bitmap of the hashes seen, by block; blocks of several tasks are joined by or."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for cell in np.unique(_cell(batch.column("hash").to_numpy().view(np.uint64))).tolist():
            held.setdefault(cell // BLOCK, np.zeros(BLOCK, bool))[cell % BLOCK] = True
    yield pa.record_batch([pa.array(list(held), pa.int64()),
                           pa.array([np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())],
                          ["block", "bits"])


def _document_windows(batches: Iterator[pa.RecordBatch], bits: Broadcast, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, n, forms in _templates(batch.column("text")):
            columns = [[], [], [], []]
            for form, (tokens, slots, doc) in enumerate(forms):
                edge = np.searchsorted(doc, np.arange(n + 1))
                for k in sizes:
                    at, hashes = _windows(tokens, slots, doc, k, form)
                    cell = _cell(hashes)
                    hit = bits.value[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1 == 1
                    at, hashes = at[hit], hashes[hit]
                    columns[0].append(hashes.view(np.int64))
                    columns[1].append(first + doc[at])
                    columns[2].append(at - edge[doc[at]])
                    columns[3] += [slots[i:i + k].view(np.int64).tolist() for i in at.tolist()]
            owner = pa.array(np.concatenate(columns[1]))
            yield pa.record_batch(
                [pa.array(np.concatenate(columns[0])), batch.column("id").take(owner), batch.column("twin").take(owner),
                 pa.array(np.concatenate(columns[2]).astype(np.int32)), pa.array(columns[3], pa.list_(pa.int64()))],
                ["hash", "id", "twin", "at", "slots"])


def contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", min_words: int = 13) -> DataFrame:
    """One row for each document and item that contaminates it: (id, twin, item_id, n_words in step,
    coverage of the item, changed: whether slots differ). ``twin`` tells rows of one id apart."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    kind = dict(items.dtypes)["item_id"]
    # Items are told apart by id and text, so that a null or repeated id mixes nothing up.
    windows = items.withColumn("twin", F.xxhash64("text"))
    windows = windows.select(F.struct("item_id", "twin").alias("item_id"), "text").mapInArrow(
        _item_windows, f"hash long, item_id struct<item_id: {kind}, twin: long>, item_at int, item_words int, k int, "
                       "item_slots array<long>, row long, form int")
    sizes = sorted(r.k for r in windows.select("k").distinct().collect())  # at most WINDOW values
    bitmap = np.zeros((1 << LOG2_BITS) // 8, np.uint8)
    for row in windows.select("hash").mapInArrow(_bits, "block long, bits binary").toLocalIterator():
        bitmap[row.block * BLOCK // 8:][:BLOCK // 8] |= np.frombuffer(row.bits, np.uint8)
    bits = spark.sparkContext.broadcast(bitmap)

    source = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    source = source.withColumn("twin", F.xxhash64("text"))
    found = source.mapInArrow(
        lambda batches: _document_windows(batches, bits, sizes),
        f"hash long, id {dict(source.dtypes)['id']}, twin long, at int, slots array<long>")
    step = found.join(windows, "hash").withColumn("shift", F.col("at") - F.col("item_at")).groupBy(
        "id", "twin", "item_id", "form", "shift").agg(
        F.first("item_words").alias("item_words"), F.first("k").alias("k"),
        F.sort_array(F.collect_set("item_at")).alias("places"),
        F.array_distinct(F.flatten(F.collect_set(F.expr(
            "filter(arrays_zip(item_slots, slots), s -> s.slots <> 0)")))).alias("pairs"))
    # The longest run of words that the windows cover without a gap.
    run = F.expr("aggregate(places, struct(cast(null as int) as last, 0 as run, 0 as most), (a, p) -> struct(p as last, "
                 "if(p <= a.last + k, a.run + p - a.last, k) as run, "
                 "greatest(a.most, if(p <= a.last + k, a.run + p - a.last, k)) as most), a -> a.most)")
    good = step.withColumn("n_words", run).where(
        (F.col("n_words") >= F.least(F.lit(min_words), F.greatest(F.col("item_words") - 1, F.least(F.lit(WINDOW), F.col("item_words")))))
        & F.expr("size(array_distinct(transform(pairs, p -> p.item_slots))) = size(pairs)")
        & F.expr("size(array_distinct(transform(pairs, p -> p.slots))) = size(pairs)"))
    return good.groupBy("id", "twin", "item_id").agg(
        F.max("n_words").alias("n_words"), F.max(F.col("n_words") / F.col("item_words")).alias("coverage"),
        F.expr("bool_and(exists(pairs, p -> p.item_slots <> p.slots))").alias("changed")).withColumn(
        "item_id", F.col("item_id.item_id"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that no item contaminates, with their columns."""
    bad = contamination(docs, benchmark, id, text, **options).select(
        F.col("id").alias("_d_id"), F.col("twin").alias("_d_twin")).distinct()
    same = F.col(id).eqNullSafe(F.col("_d_id")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("_d_twin"))
    return docs.join(bad, same, "left_anti")
