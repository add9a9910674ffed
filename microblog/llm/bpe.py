"""Byte-level BPE by corpus-level merge replay.

A task takes its block of texts as a corpus: the distinct pattern matches of
the block are laid out as one flat array of byte symbols, an inverted index
maps every mergeable pair (by the rank of its result) to the positions where it
stands, and the ranks are replayed in ascending order. A merge touches only its
two neighbours: their new pairs enter the index, stale positions are recognised
when their rank comes up. Every word ends as the tiktoken library would split
it; ids are then read off per document.

Definitions: a null text is the empty text (no ids, ``n_tokens`` 0); rows keep
their order and multiplicity, also with null or repeated ids; other columns are
not read. The rank file is read on the driver and broadcast: its size is that
of the vocabulary file, checked against ``MAX_VOCABULARY_BYTES``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import blocks, column, texts_of
from .pieces import PieceEncoder

MAX_VOCABULARY_BYTES = 64 << 20
_BITS = 21  # ids below two million


def read_ranks(path: str) -> bytes:
    """The rank file (token in base64, space, rank; a line each)."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: larger than {MAX_VOCABULARY_BYTES} bytes")
    return data


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


def pairs_of(ranks: dict[bytes, int]) -> dict[int, int]:
    """Every pair of tokens whose concatenation is a token, to its rank."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                pairs[(a << _BITS) | b] = rank
    return pairs


class MergeReplay:
    """Merges, replayed over many words at once.

    ``byte_id``: the ids of the 256 bytes. ``pairs``: two adjacent ids (the
    left one shifted by ``_BITS``) to the id that replaces them; lower ids are
    merged first, of equal ones the leftmost.
    """

    def __init__(self, byte_id: Sequence[int], pairs: dict[int, int]):
        self.byte_id = np.array(byte_id, dtype=np.int64)
        self._pairs = pairs
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        order = np.argsort(keys)
        self._keys = keys[order]
        self._ranks = np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))[order]
        self._byte_pairs = np.full(1 << 16, -1)
        self._plain = bool((np.sort(self.byte_id) == np.arange(256)).all())  # ids below 256 are the bytes
        if self._plain:
            small = ((self._keys >> _BITS) < 256) & ((self._keys & ((1 << _BITS) - 1)) < 256)
            self._byte_pairs[(self._keys[small] >> _BITS) << 8 | (self._keys[small] & 255)] = self._ranks[small]

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair's result, -1 where it is no token."""
        if not len(self._keys):
            return np.full(len(left), -1)
        key = (left << _BITS) | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], -1)

    def _alone(self, word: bytes) -> list[int]:
        """One word, the leftmost lowest rank first. Only for the few words in
        which a merge brings up a pair of no higher rank."""
        parts = self.byte_id[list(word)].tolist()
        find = self._pairs.get
        while len(parts) > 1:
            found = min(((r, i) for i in range(len(parts) - 1) if (r := find((parts[i] << _BITS) | parts[i + 1])) is not None), default=None)
            if found is None:
                break
            parts[found[1]:found[1] + 2] = [found[0]]
        return parts

    def __call__(self, words: Sequence[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit bytes."""
        return self.column(pa.array(words, pa.large_binary())).to_pylist()

    def column(self, words: pa.Array) -> pa.Array:
        """The same for a column of words (large strings or binaries, no nulls)."""
        bounds = np.frombuffer(words.buffers()[1] or bytes(8), dtype=np.int64)[words.offset:words.offset + len(words) + 1]
        size, ends = np.diff(bounds), bounds[1:] - bounds[0]
        n = int(bounds[-1] - bounds[0])
        if not n:
            return pa.array([b""] * len(words), pa.large_binary())
        first = self.byte_id[np.frombuffer(words.buffers()[2], dtype=np.uint8)[bounds[0]:bounds[-1]]]
        full = ends[size > 0]
        linked = np.ones(n, dtype=bool)
        linked[full - 1] = False  # nothing follows a word's last symbol

        here = np.arange(n)
        sym = first.copy()
        nxt = np.where(linked, here + 1, -1)
        prv = here - 1
        prv[0] = -1
        prv[full[:-1]] = -1
        result = np.full(n, -1)  # rank of the pair that starts here, -1: none
        result[:-1] = self._byte_pairs[(first[:-1] << 8 | first[1:])] if self._plain else self._rank_of(first[:-1], first[1:])
        result[~linked] = -1

        index: dict[int, list[int]] = defaultdict(list)
        at = np.flatnonzero(result >= 0)
        at = at[np.argsort(result[at], kind="stable")]
        for group in np.split(at, np.flatnonzero(np.diff(result[at])) + 1) if len(at) else []:
            index[int(result[group[0]])] = group.tolist()
        queue = list(index)
        heapq.heapify(queue)
        apart: set[int] = set()  # positions in words that are finished alone
        while queue:
            rank = heapq.heappop(queue)
            pos = np.array(index.pop(rank))
            pos = pos[result[pos] == rank]  # else an earlier merge took a part
            if not len(pos):
                continue
            gone = nxt[pos]
            if (result[gone] == rank).any():  # overlaps: from left to right
                keep, taken = [], -1
                for p in np.sort(pos).tolist():
                    if p != taken:
                        keep.append(p)
                        taken = int(nxt[p])
                pos = np.array(keep)
                gone = nxt[pos]
            after, before = nxt[gone], prv[pos]
            sym[pos], nxt[pos], sym[gone], result[gone], result[pos] = rank, after, -1, -1, -1
            more = after >= 0
            right = pos[more]
            prv[after[more]] = right
            before = before[before >= 0]
            left = np.concatenate([right, before[sym[before] != rank]])
            new = self._rank_of(sym[left], sym[nxt[left]])
            result[left] = new
            if (low := (new >= 0) & (new <= rank)).any():
                apart.update(left[low].tolist())
            some = new > rank
            for p, r in zip(left[some].tolist(), new[some].tolist()):
                got = index[r]
                if not got:
                    heapq.heappush(queue, r)
                got.append(p)

        alive = sym >= 0
        kept = np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])] * 4
        out = pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(sym[alive].astype("<u4"))])
        if apart:
            lone = out.to_pylist()
            for w in set(np.searchsorted(ends, sorted(apart), side="right").tolist()):
                word = words[w].as_py()
                lone[w] = np.array(self._alone(word.encode() if isinstance(word, str) else word), dtype="<u4").tobytes()
            out = pa.array(lone, pa.large_binary())
        return out


class Codec:
    """Texts to ids and back, for one rank table and split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        replay = MergeReplay([ranks[bytes([b])] for b in range(256)], pairs_of(ranks))
        self.encode = PieceEncoder(pattern, replay)
        self.token = {r: t for t, r in ranks.items()}

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(data: bytes, pattern: str) -> Codec:
    """One codec per worker and vocabulary."""
    key = (hashlib.sha256(data).hexdigest(), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(parse_ranks(data), pattern)
    return _codecs[key]


def _shared(df: DataFrame, ranks_path: str):
    return df.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))


def encode(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of every whole text, in order."""
    ranks = _shared(df, ranks_path)
    schema = pa.schema([(key, pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for b in blocks(batches, text):
            ids = [np.frombuffer(x, dtype="<i4") for x in codec.encode(texts_of(b, text))]
            yield pa.RecordBatch.from_arrays([column(b, key).cast(pa.int64()), pa.array(ids, type=pa.list_(pa.int32()))], schema=schema)

    return df.select(key, text).mapInArrow(run, f"`{key}` bigint, ids array<int>")


def decode(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, bytes): what the ids stand for; null ids give no bytes."""
    ranks = _shared(df, ranks_path)
    schema = pa.schema([(key, pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays([column(b, key).cast(pa.int64()), pa.array([codec.decode(x or ()) for x in column(b, ids).to_pylist()], type=pa.binary())], schema=schema)

    return df.select(key, ids).mapInArrow(run, f"`{key}` bigint, bytes binary")


def digests(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode and decode in one
    pass, without moving the ids between tasks."""
    ranks = _shared(df, ranks_path)
    schema = pa.schema([(key, pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks.value, pattern)
        decimal = {r: b"%d" % r for r in codec.token}
        for b in blocks(batches, text):
            counts, encoded, decoded = [], [], []
            for raw in codec.encode(texts_of(b, text)):
                ids = np.frombuffer(raw, dtype="<u4").tolist()
                counts.append(len(ids))
                encoded.append(hashlib.sha256(b",".join(map(decimal.__getitem__, ids))).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([column(b, key).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())], schema=schema)

    return df.select(key, text).mapInArrow(run, f"`{key}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
