"""Minimal perfect hash tables over 128-bit digests, in numpy.

Level after level, digests that are alone in their cell of a hashed array keep
it; the others go to the next, smaller level. A digest's slot is the rank of its
cell among all kept ones, so n digests have the slots 0 to n - 1. The table
holds the digests by slot: a look-up is verified, and a digest that is not in
the table is told apart.
"""

from __future__ import annotations

import numpy as np

from .common import spread64

CELLS = 1.5  # of a level, per digest that is left
MOST_LEVELS = 200


def _cells(words: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    return (spread64(words[:, 0] ^ spread64(words[:, 1] + seed)) % np.uint64(size)).astype(np.int64)


class SlotTable:
    def __init__(self, words: np.ndarray):
        """``words``: distinct digests, as rows of two uint64."""
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # of each level: which cells are kept, their first ranks
        self.slot = np.empty(len(words), np.int64)
        rest, base = np.arange(len(words)), 0
        while len(rest):
            if len(self.levels) == MOST_LEVELS:
                raise ValueError("the digests of a table must be distinct")
            size = max(8, int(CELLS * len(rest)))
            at = _cells(words[rest], len(self.levels), size)
            kept = np.bincount(at, minlength=size) == 1
            rank = base + np.cumsum(kept) - 1
            alone = kept[at]
            self.slot[rest[alone]] = rank[at[alone]]
            self.levels.append((kept, rank))
            base += int(kept.sum())
            rest = rest[~alone]
        self.words = np.empty_like(words)
        self.words[self.slot] = words

    def find(self, words: np.ndarray) -> np.ndarray:
        """The slot of every digest, -1 for those not in the table."""
        out, rest = np.full(len(words), -1, np.int64), np.arange(len(words))
        for level, (kept, rank) in enumerate(self.levels):
            at = _cells(words[rest], level, len(kept))
            here = kept[at]
            out[rest[here]] = rank[at[here]]
            rest = rest[~here]
        there = np.flatnonzero(out >= 0)
        out[there[(self.words[out[there]] != words[there]).any(axis=1)]] = -1
        return out
