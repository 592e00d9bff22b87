"""Near-duplicates by order MinHash, verified by banded alignment.

Words are runs of letters and digits in lower case; a document's k-mers are its runs of five words,
each labelled with its occurrence. A sample takes the ``pick`` smallest of them under one random
order and keeps them in text order; the hash of that tuple is a key. Two documents that share one of
the ``samples`` keys are candidates. At a similarity of 0.8 a pair shares no key with a probability
of (1 - 0.8^4)^20 = 3e-5.

Documents with the same words are one class from the start; only one of each class is compared.
First come ``ROUNDS`` rounds in which every key has one lead, and all members outside the lead's class meet it: its most
central member, whose keys are shared most. Those that turn out to be in its class are done with this key. That makes the
classes large in a few rounds. What is left are the keys that still hold several classes, such as a crowd around one
template. There every member is compared with every member of another class, in blocks, by sketches: the parities of the
numbers of k-mers in ``SKETCH`` buckets. Two sketches differ in at most as many places as there are k-mers that only one of
the documents has, so the pairs that differ in more places than the similarity allows are not similar, and no other pair
is left out. The pairs that remain are verified, the closest ones of each document first, until each is verified or lies in one class.
So all candidates end in one class or were found not to be similar. What is linked is always verified.

Two documents are linked if they have at least ``similarity`` of their labelled k-mers in common
(intersection over union) and word edits of at most 1 - ``similarity`` of the longer one, found inside the band that this
leaves. Classes are the connected components of these links.

Defined cases: texts without words (null, empty, punctuation) have the same words, none, and form
one class; a text of fewer than five words only matches the same words; rows that repeat an id are
one document; rows with a null id are left alone and have a null class; an empty table gives an
empty result. Result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlume.llm.graph import components, stored
from postlume.llm.spans import LETTERS_ONLY, mix, pieces, sequence_hash, span_hash, utf8, window_hash, word_spans

K = 5
#: Rounds with central leads, before all members of a key meet.
ROUNDS = 3
#: Buckets of a sketch, members of a key in a block, rows of a tile.
SKETCH, BLOCK, TILE = 2048, 4096, 256
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64((1 << 64) - 1)


def _labelled(kmers: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """k-mers with the number of their occurrence in the document mixed in."""
    key = mix(kmers ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    at = np.arange(len(key))
    occurrence = np.empty(len(key), np.uint64)
    occurrence[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return mix(kmers + occurrence * _STEP)


def _keys(labels: np.ndarray, first: np.ndarray, samples: int, pick: int) -> np.ndarray:
    """Keys of each document; ``first`` is where its k-mers begin, each has at least one."""
    sizes = np.diff(np.append(first, len(labels)))
    owner = np.repeat(np.arange(len(first)), sizes)
    out = np.empty((len(first), samples), np.uint64)
    for sample in range(samples):
        rank = mix(labels + np.uint64(int(_STEP) * (sample + 1) % (1 << 64)))
        places = np.empty((pick, len(first)), np.int64)
        for turn in range(pick):
            least = np.minimum.reduceat(rank, first)
            hit = np.flatnonzero(rank == least[owner])
            who = owner[hit]
            start = np.ones(len(hit), bool)
            start[1:] = who[1:] != who[:-1]
            # Shorter documents run out: their last place stands for what is missing.
            places[turn] = hit[start]
            if turn + 1 < pick:
                rank[hit[start]] = _TOP
        places.sort(axis=0)
        key = np.full(len(first), sample, np.uint64)
        for turn in range(pick):
            key = mix(key * _STEP + labels[places[turn]])
        out[:, sample] = key
    return out


def _sketches(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of bits for each document: whether an odd number of its k-mers falls into a bucket."""
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(labels))))
    place = owner * SKETCH + (mix(labels) % np.uint64(SKETCH)).astype(np.int64)
    odd = np.zeros(len(first) * SKETCH, np.uint8)
    np.add.at(odd, place, 1)  # modulo 256, which keeps parities
    return np.packbits((odd & 1).reshape(-1, SKETCH), axis=1)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, size, sketch) of texts that come as (id, text); size is their number of k-mers."""
    for batch in batches:
        for a, _, data, offsets in pieces(*utf8(pc.utf8_lower(batch.column("text")))):
            starts, ends, doc = word_spans(data, offsets, LETTERS_ONLY)
            kmers = window_hash(span_hash(data, starts, ends), K)
            inside = np.flatnonzero(doc[:len(kmers)] == doc[K - 1:]) if len(kmers) else np.zeros(0, np.int64)
            if not len(inside):
                continue
            owners = doc[inside]
            first = np.flatnonzero(np.diff(owners, prepend=-1))
            rows = _sketches(_labelled(kmers[inside], owners), first)
            yield pa.record_batch([batch.column("id").take(pa.array(a + owners[first])), pa.array(np.diff(np.append(first, len(owners)))),
                                   pa.array([row.tobytes() for row in rows], pa.binary())], ["node", "size", "sketch"])


def _close(similarity: float):
    """The pairs of members of one key and of different classes whose sketches do not rule out the similarity.
    A table holds all members of some keys, or two blocks of one, whose own pairs are in other tables."""
    def cell(table: pa.Table) -> pa.Table:
        key, label = table.column("key").to_numpy(), table.column("label").to_numpy()
        order = np.lexsort((label, key))
        table = table.take(pa.array(order))
        key, label, node, size, block = (table.column(c).to_numpy() for c in ("key", "label", "node", "size", "block"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(key), -1)
        across = len(key) > 0 and table.column("s")[0].as_py() != table.column("t")[0].as_py()
        edge = np.concatenate([np.flatnonzero(np.diff(key, prepend=~key[:1])), [len(key)]])
        lows, highs, aparts = [], [], []
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            if label[a] == label[b - 1]:
                continue
            signs = np.unpackbits(sketch[a:b], axis=1).astype(np.float32) * 2 - 1
            for i in range(a, b, TILE):
                end = min(i + TILE, b)
                # Classes ascend, so those of higher classes than the first row's come last.
                j = i + int(np.searchsorted(label[i:b], label[i], "right"))
                if j == b:
                    continue
                differ = (SKETCH - signs[i - a:end - a] @ signs[j - a:].T) / 2
                both = (size[i:end, None] + size[None, j:b]).astype(np.float64)
                # k-mers that only one has: at most (1 - similarity) / (1 + similarity) of both documents' k-mers.
                near = (differ * (1 + similarity) <= both * (1 - similarity) + 1e-6) & (label[i:end, None] < label[None, j:b])
                near &= np.abs(size[i:end, None] - size[None, j:b]) * (1 + similarity) <= both * (1 - similarity) + 1e-6
                if across:
                    near &= block[i:end, None] != block[None, j:b]
                x, y = np.nonzero(near)
                lows.append(i + x)
                highs.append(j + y)
                aparts.append(differ[x, y] / both[x, y])
        low, high = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (lows, highs))
        return pa.table({"node": node[high], "lead": node[low], "label": label[high], "lead_label": label[low],
                         "apart": np.concatenate([np.zeros(0), *aparts])})
    return cell


def _signatures(batches: Iterator[pa.RecordBatch], samples: int, pick: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("id")
        for a, b, data, offsets in pieces(*utf8(pc.utf8_lower(batch.column("text")))):
            starts, ends, doc = word_spans(data, offsets, LETTERS_ONLY)
            n = len(offsets) - 1
            edge = np.searchsorted(doc, np.arange(n + 1))
            words = span_hash(data, starts, ends)
            high = sequence_hash(words, edge[:-1], edge[1:])
            low = sequence_hash(span_hash(data, starts, ends, 1), edge[:-1], edge[1:], 1)
            kmers = window_hash(words, K)
            inside = np.flatnonzero(doc[:len(kmers)] == doc[K - 1:]) if len(kmers) else np.zeros(0, np.int64)
            keys = np.zeros((0, samples), np.uint64)
            owners = doc[inside]
            first = np.flatnonzero(np.diff(owners, prepend=-1))
            if len(inside):
                keys = _keys(_labelled(kmers[inside], owners), first, samples, pick)
            count = np.zeros(n, np.int64)
            count[owners[first]] = samples
            listed = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)),
                pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.record_batch([ids.slice(a, b - a), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), listed],
                                  ["id", "high", "low", "keys"])


def edits_within(a: list[int], b: list[int], limit: int) -> bool:
    """Whether ``limit`` insertions, deletions and substitutions lead from a to b: furthest-reaching
    points on the diagonals of the band, pushed along matches."""
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return False
    reach = {0: 0}
    goal = m - n
    for edits in range(limit + 1):
        pushed = {}
        for k, i in reach.items():
            j = i + k
            while i < n and j < m and a[i] == b[j]:
                i += 1
                j += 1
            pushed[k] = i
        if pushed.get(goal, -1) >= n:
            return True
        reach = {}
        for k, i in pushed.items():
            for to, at in ((k, i + 1), (k - 1, i + 1), (k + 1, i)):
                if at <= n and 0 <= at + to <= m and abs(goal - to) <= limit - edits - 1 and reach.get(to, -1) < at:
                    reach[to] = at
    return False


def _word_lists(column: pa.Array) -> list[np.ndarray]:
    out = []
    for _, _, data, offsets in pieces(*utf8(pc.utf8_lower(column))):
        starts, ends, doc = word_spans(data, offsets, LETTERS_ONLY)
        words = span_hash(data, starts, ends)
        edge = np.searchsorted(doc, np.arange(len(offsets)))
        out += [words[a:b] for a, b in zip(edge[:-1], edge[1:])]
    return out


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Verdict on two lists of word hashes."""
    x, y = (np.sort(_labelled(window_hash(w, K), np.zeros(max(0, len(w) - K + 1), np.int64))) for w in (a, b))
    if not len(x) or not len(y):
        return len(a) == len(b) and bool((a == b).all())
    common = len(np.intersect1d(x, y, assume_unique=True))
    if common < similarity * (len(x) + len(y) - common):
        return False
    return edits_within(a.tolist(), b.tolist(), int((1 - similarity) * max(len(a), len(b)) + 1e-9))


def _verify(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = _word_lists(batch.column("text_a")), _word_lists(batch.column("text_b"))
        good = pa.array([similar(x, y, similarity) for x, y in zip(left, right)], pa.bool_())
        names = ["node", "lead", "label", "lead_label"]
        yield pa.record_batch([batch.column(c) for c in names], names).filter(good)


def near_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = 0.8,
                 samples: int = 20, pick: int = 4) -> DataFrame:
    """(id, class_id): the smallest id of its class for each id that is not null, once."""
    texts = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).where("id is not null")
    signed = stored(texts.mapInArrow(lambda batches: _signatures(batches, samples, pick),
                                     "id long, high long, low long, keys array<long>"))
    same = stored(signed.groupBy("high", "low").agg(F.min(F.struct("id", "keys")).alias("one")).select(
        "high", "low", F.col("one.id").alias("node"), F.col("one.keys").alias("keys")))
    member = signed.join(same.select("high", "low", "node"), ["high", "low"]).select("id", "node")

    links = []

    def compared(pairs: DataFrame) -> DataFrame:
        """The pairs (node, lead, ...) that are similar."""
        wanted = pairs.select("node").union(pairs.select("lead")).toDF("id")
        # One plan for every size: no broadcast of what grows with the input.
        known = stored(texts.join(wanted.hint("shuffle_hash"), "id", "left_semi"))
        return stored(
            pairs.join(known.toDF("node", "text_a"), "node").join(known.toDF("lead", "text_b"), "lead").mapInArrow(
                lambda batches: _verify(batches, similarity), "node long, lead long, label long, lead_label long"))

    def met(open_keys: DataFrame, lead: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Who meets the lead of a key, and who is similar to it; none if nobody meets."""
        # Leads are stored: with no aggregate under the join, a key with very many members is split.
        led = stored(open_keys.join(lead, "key").where("label <> lead_label"))
        if led.isEmpty():
            return led, None
        # A node and a lead meet once, in however many keys.
        found = compared(stored(led.groupBy("node", "lead").agg(F.min("label").alias("label"), F.min("lead_label").alias("lead_label"))))
        links.append(found.select(F.col("node").alias("a"), F.col("lead").alias("b")))
        return led, found

    crowd = same.select("node", F.explode("keys").alias("key"))
    counts = stored(crowd.groupBy("key").count().where("count > 1"))
    keyed = stored(crowd.join(counts, "key"))
    shared = stored(keyed.groupBy("node").agg(F.sum("count").alias("weight")))
    # label: the class that the node is in by now.
    open_keys = stored(keyed.join(shared, "node").select("key", "node", "weight", F.col("node").alias("label")))
    for _ in range(ROUNDS):
        lead = open_keys.groupBy("key").agg(F.max(F.struct("weight", (-F.col("node")).alias("minus"), "label")).alias("lead"))
        led, found = met(open_keys, stored(lead.select(
            "key", (-F.col("lead.minus")).alias("lead"), F.col("lead.label").alias("lead_label"))))
        if found is None:
            break
        # Those that are similar take the class of a lead. Classes need not be whole while the rounds go on, only true.
        now = found.groupBy("node").agg(F.min("lead_label").alias("now"))
        # What is left of a key: those outside its lead's class, with the labels of now.
        open_keys = stored(led.join(now, "node", "left").withColumn("label", F.coalesce("now", "label")).where(
            "label <> lead_label").select("key", "node", "weight", "label"))

    # The classes of all links so far; later links start from these.
    if links:
        classes = components(reduce(DataFrame.union, links))
        links[:] = [classes.select(F.col("node").alias("a"), F.col("label").alias("b"))]

    def by_class(frame: DataFrame, node: str, label: str) -> DataFrame:
        """The frame with the class of ``node`` by now as ``label``."""
        frame = frame.drop(label)
        if not links:
            return frame.withColumn(label, F.col(node))
        return frame.join(classes.toDF(node, label), node, "left").withColumn(label, F.coalesce(label, node))

    # The keys that hold several classes by now, and all pairs of their members that may be similar.
    by_now = stored(by_class(keyed.where("count > 2").select("key", "node"), "node", "label"))
    several = stored(by_now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where(
        "low < high").select("key", F.expr(f"(n + {BLOCK - 1}) DIV {BLOCK}").alias("blocks")))
    crowded = stored(by_now.join(several, "key"))
    members = crowded.count()
    if members:
        rest = stored(crowded.select(F.col("node").alias("id")).distinct())
        sketched = stored(texts.join(rest.hint("shuffle_hash"), "id", "left_semi").mapInArrow(
            _sketched, "node long, size long, sketch binary").dropDuplicates(["node"]))
        # Small keys share a table; of a large one each pair of blocks has one.
        dealt = crowded.withColumn("block", F.expr("pmod(xxhash64(node), blocks)")).withColumn("pair", F.explode(F.expr(
            "transform(sequence(0, blocks - 1), other -> struct(least(other, block) AS s, greatest(other, block) AS t))"))).select(
            "key", "node", "label", "block", "pair.s", "pair.t", F.col("blocks") > 1,
            F.expr(f"IF(blocks > 1, key, pmod(xxhash64(key), {-(-members // BLOCK)}))")).toDF(
            "key", "node", "label", "block", "s", "t", "large", "bucket")
        close = dealt.join(sketched, "node").groupBy("bucket", "large", "s", "t").applyInArrow(
            _close(similarity), "node long, lead long, label long, lead_label long, apart double")
        pairs = stored(close.groupBy("node", "lead").agg(*(F.min(c).alias(c) for c in ("label", "lead_label", "apart"))))
        width = 2
        while not pairs.isEmpty():
            order = Window.partitionBy("node").orderBy("apart", "lead")
            ranked = stored(pairs.withColumn("turn", F.row_number().over(order)))
            found = compared(ranked.where(F.col("turn") <= width))
            left = ranked.where(F.col("turn") > width).drop("turn")
            if not found.isEmpty():
                links.append(found.select(F.col("node").alias("a"), F.col("lead").alias("b")))
                classes = components(reduce(DataFrame.union, links))
                links[:] = [classes.select(F.col("node").alias("a"), F.col("label").alias("b"))]
                left = by_class(by_class(left, "node", "label"), "lead", "lead_label")
            pairs = stored(left.where("label <> lead_label").select("node", "lead", "label", "lead_label", "apart"))
            width *= 16
    # Rows that repeat an id link their classes, as the documents that were found similar do.
    twins = stored(member.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select("a", "b"))
    if len(links) > 1 or not links or not twins.isEmpty():
        classes = components(reduce(DataFrame.union, links, twins))
    return member.join(classes, "node", "left").groupBy("id").agg(
        F.min(F.coalesce("label", "node")).alias("class_id"))


def near_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The input with class_id and kept: one document of each class is."""
    columns = [f"`{c}`" for c in docs.columns if c.lower() not in ("class_id", "kept")]
    classes = near_classes(docs, id, text, **options).toDF("_n_id", "class_id")
    joined = docs.select(*columns, F.col(id).cast("long").alias("_n_id")).join(classes, "_n_id", "left")
    return joined.drop("_n_id").withColumn("kept", F.coalesce(F.col("class_id") == F.col(id), F.lit(True)))
