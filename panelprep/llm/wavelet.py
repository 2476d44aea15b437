"""A wavelet matrix over small integers, in numpy: bit planes with rank and select."""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MAGIC = b"PPWM1\n"


class WaveletMatrix:
    """Level by level from the highest bit, the sequence is split stably into zeros and ones; a plane keeps the bits.

    ``rank`` needs a directory of ones before each 64-bit word; it's derived from
    the planes in one pass when first asked for.
    """

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros  # planes: little-endian bits, padded to whole words
        self._words: list[np.ndarray] | None = None
        self._before: list[np.ndarray] | None = None

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        n, planes, zeros = len(values), [], []
        for level in reversed(range(bits)):
            ones = (values & values.dtype.type(1 << level)) != 0
            packed = np.packbits(ones, bitorder="little")
            planes.append(np.pad(packed, (0, -len(packed) % 8 + 8)))  # a spare word, so that rank(n) needs no test
            low = np.compress(~ones, values)  # several times as fast as a boolean index here
            zeros.append(len(low))
            values = np.concatenate((low, np.compress(ones, values)))
        return cls(n, planes, zeros)

    def _directory(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        if self._words is None:
            self._words = [p.view("<u8") for p in self.planes]
            self._before = []
            for w in self._words:
                counts = np.cumsum(np.bitwise_count(w), dtype=np.int64)
                self._before.append(np.concatenate((np.zeros(1, np.int64), counts)))
        return self._words, self._before

    def _rank1(self, level: int, at: np.ndarray) -> np.ndarray:
        words, before = self._directory()
        at = np.asarray(at, np.int64)
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[level][word] + np.bitwise_count(words[level][word] & mask)

    def access(self, at: np.ndarray) -> np.ndarray:
        """Values at the positions ``at``."""
        words, _ = self._directory()
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for level, zeros in enumerate(self.zeros):
            bit = (words[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            one = self._rank1(level, at)
            out = (out << 1) | bit.astype(np.int64)
            at = np.where(bit == 1, zeros + one, at - one)
        return out

    def rank(self, value: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value occurs before each position; both arrays have one shape."""
        at = np.asarray(at, np.int64)
        start, value = np.zeros_like(at), np.asarray(value, np.int64)
        bits = len(self.planes)
        for level, zeros in enumerate(self.zeros):
            bit = (value >> (bits - 1 - level)) & 1 == 1
            one_s, one_e = self._rank1(level, start), self._rank1(level, at)
            start = np.where(bit, zeros + one_s, start - one_s)
            at = np.where(bit, zeros + one_e, at - one_e)
        return at - start

    def count(self, value: int) -> int:
        return int(self.rank(np.array([value]), np.array([self.n]))[0])

    def occurrences(self, value: int) -> np.ndarray:
        """All positions of a value, ascending: its block on the lowest plane, selected back up through the planes."""
        bits, start, end = len(self.planes), np.zeros(1, np.int64), np.array([self.n], np.int64)
        for level, zeros in enumerate(self.zeros):
            one_s, one_e = self._rank1(level, start), self._rank1(level, end)
            if (value >> (bits - 1 - level)) & 1:
                start, end = zeros + one_s, zeros + one_e
            else:
                start, end = start - one_s, end - one_e
        at = np.arange(start[0], end[0])
        for level in reversed(range(bits)):
            bit = (value >> (bits - 1 - level)) & 1
            at = self._select(level, bit, at - self.zeros[level] if bit else at)
        return at

    def _select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) one or zero of a plane."""
        words, before = self._directory()
        total = before[level] if bit else np.arange(len(before[level]), dtype=np.int64) * 64 - before[level]
        word = np.searchsorted(total, k, side="right") - 1
        rest = (k - total[word]).astype(np.int64)
        bits = np.unpackbits((words[level][word] if bit else ~words[level][word]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return word * 64 + np.argmax(np.cumsum(bits, axis=1) > rest[:, None], axis=1)

    def decode(self, dtype=np.uint16) -> np.ndarray:
        """The whole sequence, by undoing the splits from the lowest plane upwards."""
        values = np.zeros(self.n, dtype)
        for level in reversed(range(len(self.planes))):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            zeros, above = self.zeros[level], np.empty(self.n, dtype)
            above[np.flatnonzero(~ones)] = values[:zeros]
            above[np.flatnonzero(ones)] = values[zeros:] | dtype(1 << (len(self.planes) - 1 - level))
            values = above
        return values

    def to_bytes(self) -> bytes:
        """Magic, n, bits, then for each plane its zeros, its length and its zstd frame."""
        pack = zstandard.ZstdCompressor(level=1).compress
        parts = [MAGIC, struct.pack("<QB", self.n, len(self.planes))]
        for plane, zeros in zip(self.planes, self.zeros):
            frame = pack(plane.tobytes())
            parts += [struct.pack("<QQ", zeros, len(frame)), frame]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet matrix")
        n, bits = struct.unpack_from("<QB", data, len(MAGIC))
        at, planes, zeros = len(MAGIC) + 9, [], []
        unpack = zstandard.ZstdDecompressor().decompress
        for _ in range(bits):
            z, size = struct.unpack_from("<QQ", data, at)
            planes.append(np.frombuffer(unpack(data[at + 16 : at + 16 + size]), np.uint8))
            zeros.append(z)
            at += 16 + size
        return cls(n, planes, zeros)
