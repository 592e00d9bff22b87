"""Elias-Fano code of an ascending sequence, with constant-time select."""

from __future__ import annotations

import struct

import numpy as np

#: A sample of the select structure for so many values.
EVERY = 256


class EliasFano:
    """n values up to u in about 2 + log2(u / n) bits each: the low bits packed, the high parts in
    unary. Value i is found from the i-th one of the unary part; a sample of their places bounds the
    search to one stretch of it."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.samples = np.flatnonzero(np.unpackbits(high, bitorder="little"))[::EVERY]

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        low_bits = max(0, int(values[-1] // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        ones = np.zeros(int(values[-1] >> low_bits) + n if n else 0, np.uint8)
        ones[(values >> low_bits) + np.arange(n)] = 1
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little"),
                   np.packbits(ones, bitorder="little"))

    def select(self, i: int) -> int:
        """Value i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // EVERY]), i % EVERY
        byte = place // 8
        while True:
            ones = np.flatnonzero(np.unpackbits(self.high[byte:byte + 64], bitorder="little")) + byte * 8
            ones = ones[ones >= place]
            if left < len(ones):
                place = int(ones[left])
                break
            left -= len(ones)
            byte += 64
            place = byte * 8
        at = i * self.low_bits
        window = int.from_bytes(self.low[at // 8:(at + self.low_bits) // 8 + 1].tobytes(), "little")
        return (place - i) << self.low_bits | (window >> at % 8) & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
        low = bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return (ones - np.arange(self.n)) << self.low_bits | low

    def to_bytes(self) -> bytes:
        return struct.pack("<QBQ", self.n, self.low_bits, len(self.low)) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, size = struct.unpack_from("<QBQ", data)
        rest = np.frombuffer(data, np.uint8, offset=struct.calcsize("<QBQ"))
        return cls(n, low_bits, rest[:size], rest[size:])
