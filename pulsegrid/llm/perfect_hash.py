"""Minimal perfect hash functions of sets of integers.

Level by level, keys are hashed into a bit field of twice their number; a key alone in its place stays,
the others go on to the next level. A key's number is the count of set bits up to its own, so n
keys have the numbers 0 to n - 1, and the function takes a few bits a key.
"""

from __future__ import annotations

import numpy as np

ROOM = 2
LEAST = 64


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """`PerfectHash.build(distinct keys)`; calling it numbers those keys, and others at random or by -1."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, self.size = [], 0
        for bits in levels:
            self.ranks.append(self.size + np.cumsum(bits, dtype=np.int64) - bits)
            self.size += int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], keys
        while rest.size:
            size = max(LEAST, ROOM * rest.size)
            places = _places(rest, len(levels), size)
            alone = np.bincount(places, minlength=size) == 1
            levels.append(alone)
            rest = rest[~alone[places]]
        return cls(levels)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found = np.full(keys.size, -1, np.int64)
        todo = np.arange(keys.size)
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            places = _places(keys[todo], level, bits.size)
            hit = bits[places]
            found[todo[hit]] = ranks[places[hit]]
            todo = todo[~hit]
        return found

    def dump(self) -> bytes:
        """The bit fields, each behind its length."""
        parts = [np.array([len(self.levels), *(b.size for b in self.levels)], np.int64).tobytes()]
        return b"".join(parts + [np.packbits(b).tobytes() for b in self.levels])

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, 8)
        at, levels = 8 * (n + 1), []
        for size in sizes:
            held = -(-int(size) // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, held, at), count=int(size)).astype(bool))
            at += held
        return cls(levels)
