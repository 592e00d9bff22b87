"""Substring dedup: windows of words that also start earlier are cut out of the texts.

Method: a count-min prefilter, then exact groups.

1. Each task sketches the windows of its texts. A window is counted under its smallest 10-word run,
   so that neighbours share a count: two equal windows share the run, hence a run's count is never
   below that of a window under it. Partition sketches are merged by block; what is kept is one bit
   for each cell, set if its count is two or more. The size is fixed by ``log2_cells``.
2. A second pass reads the texts again and keeps the windows that every row of the sketch estimates
   as repeated. No repeated window is lost; a full sketch lets more single ones through, which costs
   time and changes nothing. Windows are first grouped inside the task, so that one common passage
   gives a row for each task, not for each copy; then all are grouped by 96-bit hash, and each one
   but the earliest is cut.

Defined cases: a null text counts as empty; a text shorter than a window loses nothing; a null id
comes before all others; rows that repeat an id are told apart by their text, rows that repeat both
are one document and get the same result; an empty table gives an empty result. Result columns
replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlume.llm.spans import mix, pieces, ranges, span_hash, utf8, window_hash, word_spans

RUN = 10
BLOCK = 1 << 16
ROWS = 2
#: Cells or windows gathered before they leave the task.
FLUSH = 1 << 21
NO_ID = -(1 << 63)


def _extreme(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The extreme of each run of ``width`` neighbours, by doubling."""
    n, size = len(x) - width + 1, 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[:n], x[width - size:width - size + n])


def _keys(words: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (word number of the first word), the smallest run in each, and the runs picked."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    run = min(RUN, k)
    runs = window_hash(words, run) | np.uint64(1)
    least = _extreme(runs, k - run + 1, np.minimum)
    inside = doc[:n] == doc[k - 1:]
    pad = np.zeros(k - run, np.uint64)
    most = _extreme(np.concatenate([pad, np.where(inside, least, np.uint64(0)), pad]), k - run + 1, np.maximum)
    at = np.flatnonzero(inside)
    return at, least[at], runs[most == runs]


def _cell(keys: np.ndarray, row: int, log2_cells: int) -> np.ndarray:
    return (mix(keys + np.uint64(row)) >> np.uint64(64 - log2_cells)) + np.uint64(row << log2_cells)


def _sketch(batches: Iterator[pa.RecordBatch], k: int, log2_cells: int) -> Iterator[pa.RecordBatch]:
    """Cells hit once and cells hit more often, by block of the sketch."""
    def flush(gathered: list[np.ndarray]) -> pa.RecordBatch:
        cell, count = np.unique(np.concatenate(gathered), return_counts=True)
        block, low = cell >> np.uint64(16), (cell & np.uint64(BLOCK - 1)).astype(np.uint16)
        number, first = np.unique(block, return_index=True)
        parts = list(zip(first, [*first[1:], len(cell)]))
        return pa.record_batch(
            [pa.array(number.astype(np.int64)),
             pa.array([low[a:b][count[a:b] == 1].tobytes() for a, b in parts], pa.binary()),
             pa.array([low[a:b][count[a:b] > 1].tobytes() for a, b in parts], pa.binary())],
            ["block", "once", "more"])

    gathered, n = [], 0
    for batch in batches:
        for _, _, data, offsets in pieces(*utf8(batch.column("text"))):
            starts, ends, doc = word_spans(data, offsets)
            picked = _keys(span_hash(data, starts, ends), doc, k)[2]
            gathered += [_cell(picked, row, log2_cells) for row in range(ROWS)]
            n += ROWS * len(picked)
            if n >= FLUSH:
                yield flush(gathered)
                gathered, n = [], 0
    if n:
        yield flush(gathered)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bit for each cell of a block: its counts add up to two or more."""
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for number, once, more in zip(*(batch.column(c).to_pylist() for c in ("block", "once", "more"))):
            held = counts.setdefault(number, np.zeros(BLOCK, np.uint8))
            cell = np.frombuffer(once, np.uint16)
            held[cell] = np.minimum(held[cell] + 1, 2)
            held[np.frombuffer(more, np.uint16)] = 2
    yield pa.record_batch(
        [pa.array(list(counts), pa.int64()),
         pa.array([np.packbits(c > 1, bitorder="little").tobytes() for c in counts.values()], pa.binary())],
        ["block", "bits"])


def repeated_cells(docs: DataFrame, k: int, log2_cells: int) -> np.ndarray:
    """The merged sketch as bits: 2^log2_cells / 4 bytes, whatever the input."""
    sketches = docs.select("text").mapInArrow(
        lambda batches: _sketch(batches, k, log2_cells), "block long, once binary, more binary")
    merged = sketches.repartition("block").mapInArrow(_merge, "block long, bits binary")
    bits = np.zeros((ROWS << log2_cells) // 8, np.uint8)
    for row in merged.toLocalIterator(prefetchPartitions=True):
        bits[row.block * BLOCK // 8:][:BLOCK // 8] = np.frombuffer(row.bits, np.uint8)
    return bits


def _group(gathered: list[list[np.ndarray]]) -> pa.RecordBatch:
    """The windows of this part of the input, each kind once: of the others only the place is kept,
    as a cut. Neighbours under one run travel in one row."""
    run, high, low, ids, twins, at = (np.concatenate(x) for x in zip(*gathered))
    order = np.lexsort((at, twins, ids))
    order = order[np.argsort(high[order], kind="stable")]
    run, high, low, ids, twins, at = (x[order] for x in (run, high, low, ids, twins, at))

    def as_before(*columns: np.ndarray) -> np.ndarray:
        out = np.ones(len(at), bool)
        out[:1] = False
        for x in columns:
            out[1:] &= x[1:] == x[:-1]
        return out

    same = as_before(high, low)
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
    cut = same & ((ids != ids[head]) | (twins != twins[head]) | (at != at[head]))
    keep = ~as_before(high, low, ids, twins, at)
    run, high, low, ids, twins, at, cut = (x[keep] for x in (run, high, low, ids, twins, at, cut))
    # A cut needs no group any more: it is dealt out by document.
    run = np.where(cut, mix(ids.view(np.uint64)), run)
    high, low = np.where(cut, np.uint64(0), high), np.where(cut, np.uint64(0), low)
    order = np.lexsort((at, run, cut, twins, ids))
    run, high, low, ids, twins, at, cut = (x[order] for x in (run, high, low, ids, twins, at, cut))
    first = np.flatnonzero(~as_before(run, ids, twins, cut))
    places = pa.ListArray.from_arrays(
        pa.array(np.append(first, len(at)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(high.view(np.int64)), pa.array(low.astype(np.uint32).view(np.int32)),
                                    pa.array(at.astype(np.int32))], ["high", "low", "at"]))
    return pa.record_batch([pa.array(run[first].view(np.int64)), pa.array(ids[first]), pa.array(twins[first].astype(np.int32)),
                            pa.array(cut[first]), places], ["run", "id", "twin", "cut", "places"])


def _windows(batches: Iterator[pa.RecordBatch], k: int, log2_cells: int, bits: Broadcast) -> Iterator[pa.RecordBatch]:
    """The windows that the sketch takes for repeated."""
    gathered, n = [], 0
    for batch in batches:
        ids, twins = batch.column("id").to_numpy(), batch.column("twin").to_numpy()
        for first, _, data, offsets in pieces(*utf8(batch.column("text"))):
            starts, ends, doc = word_spans(data, offsets)
            words = span_hash(data, starts, ends)
            at, least, _ = _keys(words, doc, k)
            for row in range(ROWS):
                cell = _cell(least, row, log2_cells)
                hit = bits.value[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1 == 1
                at, least = at[hit], least[hit]
            if not len(at):
                continue
            begin = np.searchsorted(doc, np.arange(len(offsets) - 1))
            gathered.append([least, window_hash(words, k)[at],
                             window_hash(span_hash(data, starts, ends, 1), k, 1)[at] >> np.uint64(32),
                             ids[first + doc[at]], twins[first + doc[at]], at - begin[doc[at]]])
            n += len(at)
            if n >= FLUSH:
                yield _group(gathered)
                gathered, n = [], 0
    if n:
        yield _group(gathered)


def cut_windows(docs: DataFrame, k: int, log2_cells: int) -> DataFrame:
    """id, twin and the word numbers at which windows to cut start, for documents that have some.
    ``docs`` has id, twin and text."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(repeated_cells(docs, k, log2_cells))
    found = docs.mapInArrow(
        lambda batches: _windows(batches, k, log2_cells, bits),
        "run long, id long, twin int, cut boolean, places array<struct<high: long, low: int, at: int>>")
    # Equal windows have equal runs, so that the shuffle by run brings them together.
    single = found.repartition("run").select("run", "id", "twin", "cut", F.inline("places"))
    later = single.withColumn("rank", F.expr(
        "rank() over (partition by run, high, low, cut order by id, twin, at)")).where("rank > 1 or cut")
    return later.groupBy("id", "twin").agg(F.collect_list("at").alias("cuts"))


def _kept(batches: Iterator[pa.RecordBatch], k: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    """Counts, digest and text of the words that stay."""
    for batch in batches:
        cuts = batch.column("_s_cuts")
        at_all = cuts.flatten().to_numpy(zero_copy_only=False)
        sizes = pc.fill_null(pc.list_value_length(cuts), 0).to_numpy(zero_copy_only=False)
        edge = np.concatenate([[0], np.cumsum(sizes)])
        out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
        for first, end, data, offsets in pieces(*utf8(batch.column("_s_text"))):
            starts, ends, doc = word_spans(data, offsets)
            begin = np.searchsorted(doc, np.arange(len(offsets)))
            for i in range(end - first):
                a, b = begin[i], begin[i + 1]
                raw = data[offsets[i]:offsets[i + 1]].tobytes()
                words = raw.split()
                at = at_all[edge[first + i]:edge[first + i + 1]]
                if len(at):
                    delta = np.zeros(b - a + 1, np.int64)
                    np.add.at(delta, at, 1)
                    np.add.at(delta, at + k, -1)
                    words = [words[w] for w in np.flatnonzero(np.cumsum(delta[:-1]) == 0)]
                text = b" ".join(words)
                out["n_words"].append(b - a)
                out["n_removed"].append(b - a - len(words))
                out["kept_sha256"].append(hashlib.sha256(text).hexdigest())
                if with_text:
                    # An untouched text keeps its own white space.
                    out["kept_text"].append((text if len(at) else raw).decode())
        arrays = [batch.column(c) for c in batch.schema.names if not c.startswith("_s_")]
        names = [c for c in batch.schema.names if not c.startswith("_s_")]
        arrays += [pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()),
                   pa.array(out["kept_sha256"], pa.string())]
        names += ["n_words", "n_removed", "kept_sha256"]
        if with_text:
            arrays.append(pa.array(out["kept_text"], pa.string()))
            names.append("kept_text")
        yield pa.record_batch(arrays, names)


def substring_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 20,
                    log2_cells: int = 27, with_text: bool = True) -> DataFrame:
    """The input with n_words, n_removed, kept_sha256 (of the kept words joined by one space) and,
    if asked for, kept_text: that join, or the text as it was where nothing is cut."""
    results = ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    columns = [c for c in docs.columns if c.lower() not in results]
    keyed = docs.select(
        *(F.col(f"`{c}`") for c in columns), F.coalesce(F.col(id).cast("long"), F.lit(NO_ID)).alias("_s_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_s_text"))
    keyed = keyed.withColumn("_s_twin", F.expr("cast(xxhash64(_s_text) & 2147483647L as int)"))
    cuts = cut_windows(keyed.select(F.col("_s_id").alias("id"), F.col("_s_twin").alias("twin"),
                                    F.col("_s_text").alias("text")), k, log2_cells)
    cuts = cuts.toDF("_s_id", "_s_twin", "_s_cuts").hint("shuffle_hash")
    joined = keyed.join(cuts, ["_s_id", "_s_twin"], "left")
    kinds = {"n_words": "long", "n_removed": "long", "kept_sha256": "string", "kept_text": "string"}
    kept = [f for f in joined.schema.fields if not f.name.startswith("_s_")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{c} {kinds[c]}" for c in results])
    return joined.select(*(f"`{f.name}`" for f in kept), "_s_text", "_s_cuts").mapInArrow(
        lambda batches: _kept(batches, k, with_text), schema)
