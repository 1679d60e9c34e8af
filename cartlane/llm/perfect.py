"""Minimal perfect hashing of 64-bit keys, in numpy.

Level by level, each key falls on a place of a bit array; a place that one key alone falls on is
that key's, and the others go on to the next level. A key's slot is the number of taken places
before its own, so ``n`` keys have the slots 0 to ``n - 1`` at about three bits each. A key
that was not there gets any slot or none: what stands in the slot has to tell.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from cartlane.llm.texts import mixed

#: Places per key of a level.
SPARE = 2


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mixed(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)


class PerfectHash(NamedTuple):
    sizes: tuple[int, ...]
    bits: bytes  # of all levels, each from a new 64-bit word on

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct, uint64."""
        sizes, levels = [], []
        while len(keys):
            size = 64 * -(-len(keys) * SPARE // 64)
            places = _places(keys, len(sizes), size)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(alone, bitorder="little").tobytes())
            keys = keys[~alone[places]]
        return PerfectHash(tuple(sizes), b"".join(levels))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some of those that were not there."""
        bits = np.unpackbits(np.frombuffer(self.bits, np.uint8), bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
        out = np.full(len(keys), -1, np.int64)
        open_, begin = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = begin + _places(keys[open_], level, size)
            hit = bits[at] == 1
            out[open_[hit]] = ranks[at[hit]]
            open_, begin = open_[~hit], begin + size
        return out
