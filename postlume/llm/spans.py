"""Words, spans and their hashes over whole Arrow batches of text, in numpy.

A batch is one run of UTF-8 bytes with the offsets of its texts. Hashes add up values that a non-linear
mix makes of each part together with its place, so that no regular pattern of parts cancels out; the two lanes
mix with other constants and give 128 bits together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes worked on at a time; a longer text is one piece of its own.
PIECE = 4 << 20

_MASK = (1 << 64) - 1
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_SEPARATORS = np.zeros(256, bool)
_SEPARATORS[[0x20, 9, 10, 11, 12, 13]] = True
#: For texts in lower case: everything but ASCII letters and digits and what lies beyond ASCII.
LETTERS_ONLY = np.array([not (48 <= b < 58 or 97 <= b < 123 or b > 127) for b in range(256)])
_BLOCK = 1 << 16


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and their offsets; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    offsets = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64) \
        if offsets is not None else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``limit`` bytes: first, end, bytes, offsets."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SEPARATORS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the number of its text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~separators[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first |= word & edge[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    last |= word & edge[1:]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hashes of spans: the sum of their mixed eight-byte blocks, each with its place in the span."""
    base = np.uint64(_WINDOW_BASES[lane])
    length = ends - starts
    out = np.zeros(len(starts), np.uint64)
    blocks = np.cumsum((length + 7) >> 3)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    for at in range(0, int(blocks[-1]) if len(blocks) else 0, _BLOCK):
        number = np.arange(at, min(at + _BLOCK, int(blocks[-1])))
        span = np.searchsorted(blocks, number, "right")
        place = number - (blocks[span] - ((length[span] + 7) >> 3))
        first = starts[span] + 8 * place
        spare = np.uint64(8) * np.maximum(0, 8 - (ends[span] - first)).astype(np.uint64)
        value = mix((words[first] << spare) ^ mix(place.astype(np.uint64) * _STEP + base))
        new = np.flatnonzero(np.diff(span, prepend=-1))
        out[span[new]] += np.add.reduceat(value, new)
    return mix(out + length.astype(np.uint64) * base)


def window_hash(words: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive word hashes, regardless of text."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64)
    base = _WINDOW_BASES[lane]
    out, weight = np.zeros(n - k + 1, np.uint64), 1
    for i in range(k):
        out += words[i:n - k + 1 + i] * np.uint64(weight)
        weight = weight * base & _MASK
    return mix(out)


def sequence_hash(words: np.ndarray, begin: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """Hashes of the runs begin..end of word hashes, which follow each other without overlap."""
    base = np.uint64(_WINDOW_BASES[lane])
    place = ranges(np.zeros(len(begin), np.int64), end - begin)
    value = mix(words[ranges(begin, end - begin)] ^ mix(place.astype(np.uint64) * _STEP + base))
    sums = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    upto = np.cumsum(end - begin)
    return mix(sums[upto] - sums[upto - (end - begin)] + (end - begin).astype(np.uint64) * base)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers start, start + 1, ... of each range, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
