"""SentencePiece BPE in vectorised merge rounds, and back.

A text becomes a flat array of symbols. A piece holds the space mark only in front, so the text
falls into units, each a run of marks with the word after it, that no merge crosses; each distinct
unit of a batch is encoded once. In a round every unit looks up the rank of its pairs (a hash table of both
ids, looked up again only where something changed), takes the smallest (``np.minimum.reduceat``), merges that pair wherever it
stands, leftmost first and without overlap, and is compacted; rounds go on until no pair is left.
One at a time the library would do the same merges, unless one of them makes a pair of a better
or equal rank; a unit where that happens does its leftmost merge alone in this round.

Characters without a piece are spelled as byte pieces. Only models like the shipped one are
accepted: BPE, identity normalizer, dummy prefix, white space kept, byte fallback.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from postlume.llm.spans import ranges
from postlume.llm.worker import once

MARK = 0x2581
SLOTS = 19
_NONE = np.int32((1 << 31) - 1)


class PieceModel:
    def __init__(self, proto: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(proto)
        spec, trainer = model.normalizer_spec, model.trainer_spec
        if not (trainer.model_type == 2 and trainer.byte_fallback and spec.name == "identity" and spec.add_dummy_prefix
                and not spec.remove_extra_whitespaces and not trainer.treat_whitespace_as_suffix):
            raise ValueError("not a model of the kind that this encoder follows")
        processor = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.begin, self.end = processor.bos_id(), processor.eos_id()
        kinds = [p.type for p in model.pieces]
        text = [p.piece for p in model.pieces]
        if any(kind not in (1, 2, 3, 6) for kind in kinds) or any("▁" in p.lstrip("▁") for p, k in zip(text, kinds) if k == 1):
            raise ValueError("not a model of the kind that this encoder follows")
        ids = {p: i for i, p in enumerate(text) if kinds[i] == 1}
        self.n = len(text)
        self.byte = np.zeros(256, np.int64)
        for i, kind in enumerate(kinds):
            if kind == 6:
                self.byte[int(text[i][3:5], 16)] = i
        # Symbols: pieces by id; a character without a piece is n + its code point.
        self.char = np.arange(0x110000, dtype=np.int32) + self.n
        for p, i in ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        # Equal scores count as one rank: then the leftmost pair goes first.
        scores = sorted({model.pieces[i].score for i in ids.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        pairs = []
        for p, i in ids.items():
            for cut in range(1, len(p)):
                a, b = (ids.get(x) or (self.n + ord(x) if len(x) == 1 else None) for x in (p[:cut], p[cut:]))
                if a is not None and b is not None:
                    pairs.append(((a << 32) | b, rank_of[model.pieces[i].score], i))
        pairs.sort()
        pair, rank, merged = (np.array(x, np.int64) for x in zip(*pairs))
        # A hash table with linear probing; a free slot holds no pair's key.
        self.pair = np.full(1 << SLOTS, -1, np.int64)
        self.rank = np.full(1 << SLOTS, _NONE, np.int32)
        self.merged = np.zeros(1 << SLOTS, np.int32)
        todo, slot, self.probes = np.arange(len(pair)), self._slot(pair), 0
        while len(todo):
            self.probes += 1
            _, winner = np.unique(slot, return_index=True)
            winner = winner[self.pair[slot[winner]] < 0]
            self.pair[slot[winner]] = pair[todo[winner]]
            self.rank[slot[winner]] = rank[todo[winner]]
            self.merged[slot[winner]] = merged[todo[winner]]
            rest = np.ones(len(todo), bool)
            rest[winner] = False
            todo, slot = todo[rest], (slot[rest] + 1) & ((1 << SLOTS) - 1)
        # What a piece decodes to: its text with spaces for marks, the byte, or nothing.
        said = [b"" if kinds[i] in (2, 3) else bytes([int(p[3:5], 16)]) if kinds[i] == 6 else p.replace("▁", " ").encode()
                for i, p in enumerate(text)]
        self.said_at = np.concatenate([[0], np.cumsum([len(x) for x in said])]).astype(np.int64)
        self.said = np.frombuffer(b"".join(said), np.uint8)

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).view(np.int64)

    def _look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; no rank: they do not merge."""
        key = (a.astype(np.int64) << 32) | b
        slot = self._slot(key)
        at = self.pair[slot]
        open_ = np.flatnonzero((at != key) & (at >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << SLOTS) - 1)
            at = self.pair[slot[open_]]
            open_ = open_[(at != key[open_]) & (at >= 0)]
        rank = self.rank[slot]
        rank[self.pair[slot] != key] = _NONE
        return rank, self.merged[slot]

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of units after all merges, and the sizes of the units then. No unit is empty."""
        done_symbols, done_sizes, done_units = [], [], []
        unit = np.arange(len(sizes))
        first = np.cumsum(sizes) - sizes
        rank, joined = np.full(len(symbols), _NONE), np.zeros(len(symbols), np.int32)
        if len(symbols) > 1:
            rank[:-1], joined[:-1] = self._look(symbols[:-1], symbols[1:])
            rank[first + sizes - 1] = _NONE
        while len(sizes):
            least = np.minimum.reduceat(rank, first)
            idle = least == _NONE
            if idle.any():
                keep = np.repeat(~idle, sizes)
                done_symbols.append(symbols[~keep])
                done_sizes.append(sizes[idle])
                done_units.append(unit[idle])
                symbols, rank, joined = symbols[keep], rank[keep], joined[keep]
                sizes, unit, least = sizes[~idle], unit[~idle], least[~idle]
                if not len(sizes):
                    break
                first = np.cumsum(sizes) - sizes
            # Leftmost first: of neighbours that could all merge, every other one does.
            left = np.flatnonzero(rank == np.repeat(least, sizes))
            if (np.diff(left) == 1).any():
                fresh = np.ones(len(left), bool)
                fresh[1:] = np.diff(left) > 1
                place = np.arange(len(left))
                left = left[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
            owner = np.searchsorted(first, left, "right") - 1
            opener = np.ones(len(left), bool)
            opener[1:] = owner[1:] != owner[:-1]
            if not opener.all():
                # A unit with several merges at once: would one of them make a pair that goes before the rest?
                many = np.flatnonzero(np.bincount(owner)[owner] > 1)
                l, o = left[many], owner[many]
                made, worse = joined[l], np.full(len(many), _NONE)
                after = symbols.copy()
                after[left] = joined[left]
                merges = np.zeros(len(symbols), bool)
                merges[left] = True
                before = np.maximum(l - 1, 0)
                before -= merges[np.maximum(before - 1, 0)] & (before > 0)
                has = l > first[o]
                worse[has] = self._look(after[before[has]], made[has])[0]
                has = l + 2 < (first + sizes)[o]
                worse[has] = np.minimum(worse[has], self._look(made[has], symbols[l[has] + 2])[0])
                bad = np.zeros(len(sizes), bool)
                bad[o[worse <= least[o]]] = True
                good = opener | ~bad[owner]
                left, owner = left[good], owner[good]
            symbols[left] = joined[left]
            keep = np.ones(len(symbols), bool)
            keep[left + 1] = False
            sizes = sizes - np.bincount(owner, minlength=len(sizes))
            symbols, rank, joined = symbols[keep], rank[keep], joined[keep]
            first = np.cumsum(sizes) - sizes
            # Only the pairs of what was merged are new.
            here = left - np.arange(len(left))
            ends = here == (first + sizes - 1)[owner]
            opens = here == first[owner]
            rank[here[ends]] = _NONE
            new = np.concatenate([here[~ends], here[~opens] - 1])
            rank[new], joined[new] = self._look(symbols[new], symbols[new + 1])
        if not done_units:
            return symbols, sizes
        units, counts = np.concatenate(done_units), np.concatenate(done_sizes)
        flat = np.concatenate(done_symbols)
        begin = np.cumsum(counts) - counts
        order = np.argsort(units, kind="stable")
        return flat[ranges(begin[order], counts[order])], counts[order]

    def _spell(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids: what is no piece goes to its bytes."""
        odd = np.flatnonzero(symbols >= self.n)
        if not len(odd):
            return symbols, sizes
        width = np.ones(len(symbols), np.int64)
        spelled = [self.byte[np.frombuffer(chr(c).encode(), np.uint8)] for c in (symbols[odd] - self.n).tolist()]
        width[odd] = [len(x) for x in spelled]
        out = np.repeat(symbols, width)
        at = np.cumsum(width) - width
        out[ranges(at[odd], width[odd])] = np.concatenate(spelled)
        edge = np.concatenate([[0], np.cumsum(sizes)])
        total = np.concatenate([[0], np.cumsum(width)])
        return out, total[edge[1:]] - total[edge[:-1]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, begin and end included, and the number of ids of each."""
        # The dummy prefix: an empty text stays empty.
        points = np.frombuffer("".join("▁" + t if t else "" for t in texts).encode("utf-32-le"), np.uint32)
        points = np.where(points == 32, np.uint32(MARK), points)
        lengths = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        begin = np.cumsum(lengths) - lengths
        mark = points == MARK
        opens = mark.copy()
        opens[1:] &= ~mark[:-1]
        opens[begin[lengths > 0]] = True
        starts = np.flatnonzero(opens)
        sizes = np.diff(np.append(starts, len(points)))
        kind, one = distinct(points, starts, sizes)
        symbols, counts = self.merge(self.char[points[ranges(starts[one], sizes[one])]].astype(np.int64), sizes[one])
        ids, counts = self._spell(symbols, counts)
        at = np.cumsum(counts) - counts
        owner = np.searchsorted(begin[lengths > 0], starts, "right") - 1
        owner = np.flatnonzero(lengths > 0)[owner] if len(starts) else owner
        total = np.bincount(owner, counts[kind], len(texts)).astype(np.int64) + 2
        out = np.full(int(total.sum()), self.end, np.int64)
        edge = np.cumsum(total) - total
        out[edge] = self.begin
        inner = np.ones(len(out), bool)
        inner[edge] = False
        inner[edge + total - 1] = False
        out[inner] = ids[ranges(at[kind], counts[kind])]
        return out, total

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 of each run of ids, without the space of the dummy prefix."""
        size = np.diff(self.said_at)[ids]
        flat = self.said[ranges(self.said_at[ids], size)].tobytes()
        total = np.concatenate([[0], np.cumsum(size)])
        edge = total[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[a + (flat[a:a + 1] == b" "):b] if b > a else b"" for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]


def _make_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    out = []
    for base in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)):
        powers = np.full(n, base, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers))
    return out[0], out[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    # Those for an uncommonly long text are not kept.
    return once(("powers", n), lambda: _make_powers(n)) if n <= 1 << 23 else _make_powers(n)


def distinct(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each unit, and one unit of each kind. Hashes sort; the characters decide."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    step, back = _powers(1 << max(16, int(len(points)).bit_length()))
    sums = np.zeros(len(points) + 1, np.uint64)
    spread = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    np.cumsum((spread ^ (spread >> np.uint64(29))) * step[:len(points)], out=sums[1:])
    key = (sums[starts + sizes] - sums[starts]) * back[starts] + sizes.astype(np.uint64)
    # Numbers by first appearance: a kind is new where its number exceeds all before.
    kind = pd.factorize(key)[0].astype(np.int64)
    one = np.flatnonzero(np.diff(np.maximum.accumulate(kind), prepend=-1))
    twin = one[kind]
    odd = sizes != sizes[twin]
    same = np.repeat(~odd, sizes)
    place = ranges(starts, sizes)
    off = points[place[same]] != points[ranges(starts[twin], sizes)[same]] if not odd.any() else None
    if off is None or off.any():  # two kinds under one hash: no grouping for this batch
        return np.arange(len(starts)), np.arange(len(starts))
    return kind, one
