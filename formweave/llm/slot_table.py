"""A minimal perfect hash of 128-bit keys, in flat numpy arrays."""

from __future__ import annotations

import numpy as np

from formweave.llm.arrays import MULT, mix

MAX_LEVELS = 64


class SlotTable:
    """Gives ``n`` distinct keys (rows of two uint64) the slots ``0 .. n-1``.

    Each level hashes the keys left to twice as many places; a key alone in
    its place keeps it, the others go on to the next level.  The slot is the
    rank of the place among all kept ones.  Every slot stores its key, so a
    lookup verifies it: foreign keys give -1, never another key's slot."""

    def __init__(self, keys: np.ndarray):
        self.bits: list[np.ndarray] = []
        left = np.arange(len(keys))
        while len(left):
            if len(self.bits) == MAX_LEVELS:
                raise ValueError("repeated keys have no minimal perfect hash")
            place = self._places(keys[left], len(self.bits), 2 * len(left))
            alone = np.bincount(place, minlength=2 * len(left)) == 1
            self.bits.append(alone)
            left = left[~alone[place]]
        self.ranks, before = [], 0
        for b in self.bits:
            self.ranks.append(before + np.cumsum(b) - 1)
            before += int(b.sum())
        self.keys = np.empty_like(keys)
        self.keys[self._find(keys)] = keys

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = mix(np.array([level], np.uint64) + MULT)
        return (mix(keys[:, 0] ^ mix(keys[:, 1] + seed)) % np.uint64(size)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks)):
            place = self._places(keys[left], level, len(bits))
            hit = bits[place]
            slot[left[hit]] = ranks[place[hit]]
            left = left[~hit]
        return slot

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        slot = self._find(keys)
        if len(self.keys):
            slot[(self.keys[slot] != keys).any(axis=1)] = -1
        return slot
