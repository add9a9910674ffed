"""Cuckoo filters over 128-bit digests, in numpy.

A digest has a 16-bit fingerprint and two buckets of four slots; either bucket
follows from the other one and the fingerprint, so entries can move and can be
deleted again. Fingerprints that find no room go to a sorted stash, so that
nothing inserted is ever answered with no, however full the table is; a crowded
filter only grows.

Definitions: digests are rows of two uint64 numbers. A digest that is added
twice is held twice. Removing what was never added is an error of the caller.
"""

from __future__ import annotations

import struct

import numpy as np

from .common import spread64

SLOTS = 4
LOAD = 0.8  # of a new table
ROUNDS = 200  # of evictions before the rest goes to the stash
_HEAD = struct.Struct("<qq")


def digest_words(digests) -> np.ndarray:
    """Digests of 16 bytes (a sequence of bytes) as rows of two uint64."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


class CuckooFilter:
    def __init__(self, keys: int = 0):
        """Room for ``keys`` digests at the usual load."""
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD)))))
        self.slots = np.zeros((buckets, SLOTS), np.uint16)
        self.stash = np.empty(0, np.uint64)

    def _other(self, mark: np.ndarray, at: np.ndarray) -> np.ndarray:
        return at ^ (spread64(mark).astype(np.int64) & (len(self.slots) - 1))

    def _places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and first bucket of every digest."""
        mark = (words[:, 1] >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        return mark, spread64(words[:, 1]).astype(np.int64) & (len(self.slots) - 1)

    def _codes(self, mark: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What a stash entry is known by: the smaller bucket and the fingerprint."""
        return np.minimum(at, self._other(mark, at)).astype(np.uint64) << np.uint64(16) | mark.astype(np.uint64)

    def _settle(self, mark: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fill free slots of the buckets ``at``; what finds none comes back."""
        order = np.argsort(at, kind="stable")
        mark, at = mark[order], at[order]
        new = np.flatnonzero(np.diff(at, prepend=-1))
        turn = np.arange(len(at)) - np.repeat(new, np.diff(np.append(new, len(at))))
        free = self.slots[at] == 0
        hit = free & (np.cumsum(free, axis=1) == turn[:, None] + 1)
        fits = hit.any(axis=1)
        self.slots[at[fits], hit[fits].argmax(axis=1)] = mark[fits]
        return mark[~fits], at[~fits]

    def add(self, words: np.ndarray) -> None:
        mark, at = self._settle(*self._places(words))
        rng = np.random.default_rng(len(words))
        for _ in range(ROUNDS):
            mark, at = self._settle(mark, self._other(mark, at))
            if not len(mark):
                return
            # one of each full bucket takes the place of an entry, which moves on
            _, first = np.unique(at, return_index=True)
            slot = rng.integers(SLOTS, size=len(first))
            out = self.slots[at[first], slot]
            self.slots[at[first], slot] = mark[first]
            mark[first] = out
        self.stash = np.sort(np.concatenate([self.stash, self._codes(mark, at)]))

    def holds(self, words: np.ndarray) -> np.ndarray:
        """False: surely not added. True: added, or taken for another."""
        mark, at = self._places(words)
        found = (self.slots[at] == mark[:, None]).any(axis=1) | (self.slots[self._other(mark, at)] == mark[:, None]).any(axis=1)
        return found | np.isin(self._codes(mark, at), self.stash) if len(self.stash) else found

    def remove(self, words: np.ndarray) -> None:
        mark, at = self._places(words)
        while len(mark):
            codes = self._codes(mark, at)
            _, first = np.unique(codes, return_index=True)  # entries of different codes lie in different slots
            left = first
            for places in (at, self._other(mark, at)):
                hit = self.slots[places[left]] == mark[left][:, None]
                there = hit.any(axis=1)
                self.slots[places[left[there]], hit[there].argmax(axis=1)] = 0
                left = left[~there]
            if len(left):
                gone = np.searchsorted(self.stash, codes[left])
                if (gone == len(self.stash)).any() or (self.stash[gone] != codes[left]).any():
                    raise ValueError("a digest to be removed is not in the filter")
                self.stash = np.delete(self.stash, gone)
            rest = np.setdiff1d(np.arange(len(mark)), first)
            mark, at = mark[rest], at[rest]

    def to_bytes(self) -> bytes:
        return _HEAD.pack(len(self.slots), len(self.stash)) + self.slots.astype("<u2").tobytes() + self.stash.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        out = cls()
        buckets, stash = _HEAD.unpack_from(data)
        out.slots = np.frombuffer(data, "<u2", buckets * SLOTS, _HEAD.size).reshape(-1, SLOTS).copy()
        out.stash = np.frombuffer(data, "<u8", stash, _HEAD.size + buckets * SLOTS * 2).copy()
        return out
