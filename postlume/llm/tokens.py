"""Token counts, token ids as files, and pieces there and back, over whole tables.

Defined cases for all three: a null text counts as empty; rows are worked on one by one, so repeated
rows repeat their results; an empty table gives an empty result. Tokenizer files are read once on the
driver (a few MB, whatever the input) and sent along with the code.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlume.llm.bytepairs import BytePairCounter, splits_like_the_transducer
from postlume.llm.eliasfano import EliasFano
from postlume.llm.pieces import PieceModel, distinct
from postlume.llm.pretokens import pretokens, strings
from postlume.llm.spans import pieces, ranges, utf8
from postlume.llm.worker import once
from postlume.session import shared_dir

#: Bytes of text worked on together, and where ids are stored, whose encoder takes some 80 bytes for each of them.
PIECE = 4 << 20
STORED_PIECE = 1 << 20
#: Ids in a stored segment, and words that an encoder remembers.
SEGMENT = 1 << 21
WORDS = 1_000_000


def _load(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _texts(batch: pa.RecordBatch, column: str, size: int = PIECE) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of texts of a bounded size."""
    texts = batch.column(column)
    for first, end, _, _ in pieces(*utf8(texts), size):
        yield first, end, [t or "" for t in texts.slice(first, end - first).to_pylist()]


def _others(docs: DataFrame, results: list[str], text: str) -> tuple[DataFrame, list[str], str]:
    """The input with its text as _t_text, its other columns, and their types for a schema."""
    columns = [f for f in docs.schema.fields if f.name.lower() not in results]
    frame = docs.select(*(f"`{f.name}`" for f in columns), F.coalesce(F.col(text), F.lit("")).alias("_t_text"))
    return frame, [f.name for f in columns], "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in columns)


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """The input with n_bytes, n_tokens and over_limit, by the compiled transducer for a byte-level
    BPE file."""
    frame, names, types = _others(docs, ["n_bytes", "n_tokens", "over_limit"], text)
    data = docs.sparkSession.sparkContext.broadcast(_load(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once(("count", tokenizer), lambda: BytePairCounter(data.value))
        for batch in batches:
            counts = [counter.count(texts) for _, _, texts in _texts(batch, "_t_text")]
            tokens = np.concatenate([np.zeros(0, np.int64), *counts])
            size = np.diff(utf8(batch.column("_t_text"))[1])
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(size), pa.array(tokens), pa.array(tokens > limit)],
                                  [*names, "n_bytes", "n_tokens", "over_limit"])

    return frame.mapInArrow(run, types + "n_bytes long, n_tokens long, over_limit boolean")


class _WordEncoder:
    """The tokenizers library, asked once for each distinct word of late."""

    def __init__(self, data: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_buffer(data)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        splits_like_the_transducer(json.loads(data))
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _known(self, words: list[str]) -> np.ndarray:
        if len(self.number) > WORDS:
            self.clear()
        at = np.fromiter((self.number.get(w, -1) for w in words), np.int64, len(words))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [words[i] for i in missing.tolist()]
            found = self.library.encode(new, is_pretokenized=True, add_special_tokens=False)
            sizes = np.bincount(np.array(found.word_ids, np.int64), minlength=len(new))
            self.ids = np.concatenate([self.ids, np.array(found.ids, np.uint32)])
            self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(sizes)])
            at[missing] = np.arange(len(self.number), len(self.number) + len(new))
            self.number.update(zip(new, at[missing].tolist()))
        return at

    def encode(self, texts: list[str], last: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with ``last`` behind it, and their numbers."""
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        plain = list(texts)
        for i in odd:
            plain[i] = ""
        points, starts, sizes, owner = pretokens(plain)
        kind, one = distinct(points, starts, sizes)
        known = self._known(strings(points, starts[one], sizes[one]))[kind]
        size = (self.at[known + 1] - self.at[known])
        flat = self.ids[ranges(self.at[known], size)]
        count = np.bincount(owner, size, len(texts)).astype(np.int64)
        whole = {i: np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32) for i in odd}
        for i, ids in whole.items():
            count[i] = len(ids)
        out = np.full(int(count.sum()) + len(texts), last, np.uint32)
        edge = np.concatenate([[0], np.cumsum(count + 1)])
        inner = np.ones(len(out), bool)
        inner[edge[1:] - 1] = False
        for i, ids in whole.items():
            out[edge[i]:edge[i] + len(ids)] = ids
            inner[edge[i]:edge[i] + len(ids)] = False
        out[inner] = flat
        return out, count + 1


SEGMENTS = "shard int, segment int, start long, n_ids long, width int, ids binary, bounds binary, doc_ids array<long>"


def write_ids(docs: DataFrame, tokenizer: str, folder: str, id: str = "doc_id", text: str = "text", last: int = 2) -> None:
    """Ids of all documents in ascending order of their id (nulls first, ties by text), ``last``
    behind each, as segments: the ids one after another in 2 or 4 bytes each, and the Elias-Fano code
    of where documents begin. A shard is a range of ids; a document lies in one segment. The
    segments are rows of Parquet, so that any store that Spark writes to will do."""
    data = docs.sparkSession.sparkContext.broadcast(_load(tokenizer))
    frame = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    frame = frame.withColumn("tie", F.xxhash64("text")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("encode", tokenizer), lambda: _WordEncoder(data.value))
        width = 2 if encoder.library.get_vocab_size() < 1 << 16 else 4
        shard, segment, start = TaskContext.get().partitionId(), 0, 0
        held_ids, held_counts, held_docs, n = [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids, counts = np.concatenate(held_ids), np.concatenate(held_counts)
            bounds = EliasFano.of(np.concatenate([[0], np.cumsum(counts)]))
            return pa.record_batch(
                [pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([width], pa.int32()),
                 pa.array([ids.astype(f"<u{width}").tobytes()], pa.binary()), pa.array([bounds.to_bytes()], pa.binary()),
                 pa.array([[i for x in held_docs for i in x]], pa.list_(pa.int64()))],
                ["shard", "segment", "start", "n_ids", "width", "ids", "bounds", "doc_ids"])

        for batch in batches:
            for first, end, texts in _texts(batch, "text", STORED_PIECE):
                ids, counts = encoder.encode(texts, last)
                held_ids.append(ids)
                held_counts.append(counts)
                held_docs.append(batch.column("id").slice(first, end - first).to_pylist())
                n += len(ids)
                if n >= SEGMENT:
                    yield flush()
                    segment, start = segment + 1, start + n
                    held_ids, held_counts, held_docs, n = [], [], [], 0
        if held_ids:
            yield flush()

    frame.select("id", "text").mapInArrow(run, SEGMENTS).write.option("compression", "zstd").parquet(folder)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start among all ids, n_tokens, ids_crc32."""
    segments = spark.read.schema(SEGMENTS).parquet(folder)
    # One row for each shard, that is for each partition of the writing job.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.expr("sum(n) over (order by shard) - n").alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                start, before, width, ids, bounds = (batch.column(c)[row].as_py() for c in ("start", "before", "width", "ids", "bounds"))
                edge = EliasFano.from_bytes(bounds).all()
                wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
                yield pa.record_batch(
                    [batch.column("doc_ids")[row].values, pa.array(edge[:-1] + start + before), pa.array(np.diff(edge)),
                     pa.array([zlib.crc32(wide[a:b].tobytes()) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.join(F.broadcast(shards), "shard").select("start", "before", "width", "ids", "bounds", "doc_ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def ids_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/ids-{uuid.uuid4().hex}"


def encode_pieces(docs: DataFrame, model: str, text: str = "text", with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """The input with n_tokens (begin and end included), ids_sha256 (of the ids as little-endian
    unsigned 32-bit integers) and decoded_sha256; if asked for, also ids and decoded_text."""
    results = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids + ["decoded_text"] * with_text
    kinds = {"n_tokens": "long", "ids": "array<int>"}
    frame, names, types = _others(docs, results, text)
    data = docs.sparkSession.sparkContext.broadcast(_load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces_ = once(("pieces", model), lambda: PieceModel(data.value))
        for batch in batches:
            for first, end, texts in _texts(batch, "_t_text"):
                ids, counts = pieces_.encode(texts)
                raw, edge = ids.astype("<u4"), np.concatenate([[0], np.cumsum(counts)])
                decoded = pieces_.decode(ids, counts)
                made = {"n_tokens": pa.array(counts),
                        "ids_sha256": pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.string()),
                        "decoded_sha256": pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string())}
                if with_ids:
                    made["ids"] = pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(ids.astype(np.int32)))
                if with_text:
                    made["decoded_text"] = pa.array([d.decode() for d in decoded], pa.string())
                part = batch.slice(first, end - first)
                yield pa.record_batch([*(part.column(c) for c in names), *(made[c] for c in results)], [*names, *results])

    return frame.mapInArrow(run, types + ", ".join(f"{c} {kinds.get(c, 'string')}" for c in results))
