"""Byte-level BPE token counts by a compiled transducer.

What the merges make of a string is fixed by its last tokens: the encoding of a prefix ends in the
one token t for which (last token before t, t) is a pair that merging leaves alone. So a state holds,
for each place from which a token may still be growing, the token that ends there and its count
relative to here. It is a finite deterministic machine over bytes; each transition is annotated with
the tokens it emits (none or one, or fewer than before where a longer token swallows several). States
and transitions are compiled when first met and kept for the life of the worker process, up to a
bound; from then on a batch walks its distinct pieces through the table in step.
"""

from __future__ import annotations

import json

import numpy as np

from postlume.llm.pieces import distinct
from postlume.llm.pretokens import pretokens, strings

#: Transitions kept; beyond that the machine is compiled anew, which costs time only.
TRANSITIONS = 1 << 20


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins for bytes in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    out |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return out


def splits_like_the_transducer(spec: dict) -> None:
    """Refuses a tokenizer file of another kind."""
    model, split = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or split != {**split, "type": "ByteLevel", "add_prefix_space": False, "use_regex": True} \
            or spec["normalizer"] or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError("not a byte-level BPE of the expected kind")


class BytePairCounter:
    def __init__(self, data: bytes):
        spec = json.loads(data)
        splits_like_the_transducer(spec)
        model = spec["model"]
        letters = _byte_letters()
        word = {t: bytes(letters[c] for c in t) for t in model["vocab"] if all(c in letters for c in t)}
        special = {t["content"] for t in spec["added_tokens"]}
        self.special = sorted(special)
        self.tokens = {word[t] for t in word if t not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(word[a], word[b]): i for i, (a, b) in enumerate(pairs)}
        self.prefixes = {t[:i] for t in self.tokens for i in range(1, len(t))}
        self._alone: dict[tuple[bytes, bytes], bool] = {}
        self.clear()

    def clear(self) -> None:
        # A state: (suffix, token before it or None at the start, tokens before it relative to here), longest first.
        self.states = [((b"", None, 0),)]
        self.number = {self.states[0]: 0}
        self.keys = np.full(TRANSITIONS * 2, -1, np.int64)
        self.next = np.zeros(TRANSITIONS * 2, np.int32)
        self.emits = np.zeros(TRANSITIONS * 2, np.int16)
        self.kept = 0

    def encode(self, text: bytes) -> list[bytes]:
        parts = [bytes([b]) for b in text]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _stands(self, before: bytes | None, token: bytes) -> bool:
        """Whether merging leaves this pair of tokens, or this token at the start, as it is."""
        key = (before, token)
        if key not in self._alone:
            self._alone[key] = self.encode((before or b"") + token) == ([token] if before is None else [before, token])
        return self._alone[key]

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        places = [(suffix + bytes([byte]), before, count) for suffix, before, count in self.states[state]]
        last, count = next((s, c + 1) for s, b, c in places if s in self.tokens and self._stands(b, s))
        rest = tuple((s, b, c - count) for s, b, c in places if s in self.prefixes) + ((b"", last, 0),)
        if rest not in self.number:
            self.number[rest] = len(self.states)
            self.states.append(rest)
        return self.number[rest], count

    def _find(self, key: np.ndarray) -> np.ndarray:
        """Slot of each key, or of the free place where it belongs."""
        mask = len(self.keys) - 1
        slot = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - len(self.keys).bit_length())).view(np.int64)
        open_ = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            held = self.keys[slot[open_]]
            open_ = open_[(held != key[open_]) & (held >= 0)]
        return slot

    def _walk(self, state: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = state.astype(np.int64) << 8 | byte
        slot = self._find(key)
        missing = np.unique(key[self.keys[slot] != key])
        for k in missing:
            s = self._find(np.array([k]))[0]
            self.next[s], self.emits[s] = self._compile(int(k) >> 8, int(k) & 255)
            self.keys[s] = k
        self.kept += len(missing)
        if len(missing):
            slot = self._find(key)
        return self.next[slot], self.emits[slot]

    def count_pieces(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece, walked side by side. No piece is empty."""
        if self.kept > TRANSITIONS // 2:
            self.clear()
        sizes = np.array([len(p) for p in pieces], np.int64)
        data, begin = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        alive = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")
        total, state = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int32)
        for step, n in enumerate(alive.tolist()):
            if self.kept > TRANSITIONS:  # too many in one go: on with what these pieces still need
                held = [self.states[s] for s in state[:n].tolist()]
                self.clear()
                for s in dict.fromkeys(held):
                    if s not in self.number:
                        self.number[s] = len(self.states)
                        self.states.append(s)
                state[:n] = [self.number[s] for s in held]
            state[:n], emitted = self._walk(state[:n], data[begin[order[:n]] + step])
            total[order[:n]] += emitted
        return total

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text. The strings of special tokens count as one token each, as the library has it."""
        parts, owner, extra = texts, np.arange(len(texts)), np.zeros(len(texts), np.int64)
        if any(s in t for s in self.special for t in texts):
            parts, owner = [], []
            for i, text in enumerate(texts):
                pieces = [text]
                for s in self.special:
                    pieces = [x for piece in pieces for x in piece.split(s)]
                extra[i] = len(pieces) - 1
                parts += pieces
                owner += [i] * len(pieces)
            owner = np.array(owner, np.int64)
        points, starts, sizes, text = pretokens(parts)
        kind, one = distinct(points, starts, sizes)
        counts = self.count_pieces([p.encode() for p in strings(points, starts[one], sizes[one])])
        return np.bincount(owner[text], counts[kind], len(texts)).astype(np.int64) + extra
