"""Splitting texts for byte-level BPE and reusing the ids of repeated words.

No match of the split pattern crosses from a non-space character to a space,
and the pattern looks at nothing before a match. So a text may be cut before
every space that follows a non-space character, and every piece can be encoded
on its own. Pieces repeat a lot: each distinct one is matched against the
pattern once per block, each distinct match is encoded once. Pieces and their ids
stay Arrow columns; only what is no plain word becomes strings.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")
#: Latin letters, then at most one mark: no other match of the pattern in them.
_LETTERS = r"\A(?P<letters>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+)(?P<mark>[.,;:!?]?)\z"
_SPACE, _NOTHING, _NO_IDS = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar(b"", pa.large_binary())


def _texts(values: Iterable[str]) -> pa.Array:
    return pa.array(values, pa.large_string())


def _ids(values: Iterable[bytes]) -> pa.Array:
    return pa.array(values, pa.large_binary())


class _Table:
    """Pieces after a space, kept without it, and the bytes of their ids."""

    def __init__(self, pieces: pa.Array | None = None, ids: pa.Array | None = None):
        self.pieces, self.ids = (_texts([]), _ids([])) if pieces is None else (pieces, ids)

    def __len__(self) -> int:
        return len(self.pieces)

    def __add__(self, other: _Table) -> _Table:
        return _Table(pa.concat_arrays([self.pieces, other.pieces]), pa.concat_arrays([self.ids, other.ids])) if len(other) else self

    def take(self, at: pa.Array) -> _Table:
        return _Table(self.pieces.take(at), self.ids.take(at))

    def where(self, pieces: pa.Array) -> pa.Array:
        return pc.index_in(pieces, value_set=self.pieces)

    def chars(self) -> int:
        return pc.sum(pc.binary_length(self.pieces)).as_py() or 0


class PieceEncoder:
    """Encodes texts to ids (little-endian unsigned 32-bit bytes).

    ``encode_words`` gets a list of distinct pattern matches and returns the
    bytes of their ids; one that has a method ``column`` is given a column of
    them and returns one. What was encoded is kept as long as the worker; when it
    comes to more than ``entries`` words or ``chars`` bytes it becomes the older
    generation, from which words still in use are taken over: a bound on memory
    only, results do not depend on it.
    """

    def __init__(self, pattern: str, encode_words: Callable[[Sequence[str]], Sequence[bytes]],
                 entries: int = 100_000, chars: int = 6_000_000):
        self._find = regex.compile(pattern).findall
        self._encode = getattr(encode_words, "column", None) or (lambda words: _ids(encode_words(words.to_pylist())))
        self._entries, self._chars = entries, chars
        self._old = _Table()
        self._clear()

    def _clear(self) -> None:
        self._first: dict[str, bytes] = {}  # pieces at the start of a text
        self._rest = _Table()
        self._words: dict[str, bytes] = {}  # matches in pieces that are no plain words
        self._held = 0

    def _learn(self, first: set[str], pieces: pa.Array, known: _Table) -> _Table:
        """Pieces at the start of a text are taken in; those after a space, none
        of them known, are returned with their ids, among others."""
        words = self._words
        alone = pc.ascii_is_alpha(pieces)  # what the expression finds in most pieces
        other = pieces.filter(pc.invert(alone))
        found = pc.extract_regex(other, pattern=_LETTERS)
        latin = pc.is_valid(found)
        found = found.filter(latin)
        letters, mark = pc.struct_field(found, "letters"), pc.struct_field(found, "mark")
        stems = pc.unique(letters)
        stems = stems.filter(pc.is_null(known.where(stems)))
        plain = pc.unique(pa.concat_arrays([pieces.filter(alone), stems]))
        marked = pc.not_equal(mark, _NOTHING)
        letters, mark, ended = letters.filter(marked), mark.filter(marked), other.filter(latin).filter(marked)
        mixed = [(p, self._find(" " + p)) for p in other.filter(pc.invert(latin)).to_pylist()]
        heads = [(p, self._find(p)) for p in first.difference(self._first)]
        marks = pc.unique(mark)
        new = {w for _, ws in mixed for w in ws}.union(*[ws for _, ws in heads], marks.to_pylist())
        new = [w for w in new if w not in words]
        ids = self._encode(pa.concat_arrays([pc.binary_join_element_wise(_SPACE, plain, _NOTHING), _texts(new)]))
        words.update(zip(new, ids[len(plain):].to_pylist()))
        for p, ws in heads:
            self._first[p] = b"".join([words[w] for w in ws])
        self._held += sum(len(p) for p, _ in heads) + sum(map(len, new))
        fresh = _Table(plain, ids[:len(plain)])
        if len(ended):
            stem = known + fresh
            end = _ids([words[m] for m in marks.to_pylist()]).take(pc.index_in(mark, value_set=marks))
            fresh += _Table(ended, pc.binary_join_element_wise(stem.ids.take(stem.where(letters)), end, _NO_IDS))
        return fresh + _Table(_texts([p for p, _ in mixed]), _ids([b"".join([words[w] for w in ws]) for _, ws in mixed]))

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        if not texts:
            return []
        held = self._held + self._rest.chars()
        if max(len(self._rest), len(self._words)) > self._entries or held > self._chars:
            self._old = _Table() if held > self._chars else self._rest  # one older generation stays
            self._clear()
        parts = pc.split_pattern(_texts(texts), " ")
        bounds = parts.offsets.to_numpy()
        coded = parts.flatten().dictionary_encode()
        at, pieces = coded.indices.to_numpy(), coded.dictionary
        del parts, coded
        starts = bounds[:-1]
        # few distinct pieces tell whether any space follows one: no need to search all texts
        last = pc.utf8_slice_codeunits(pieces, -1).dictionary_encode()
        ends = np.array([not c or c.isspace() for c in last.dictionary.to_pylist()])[last.indices.to_numpy()]
        odd = {}
        if ends.any():
            odd = {i: _CUT.split(texts[i]) for i in np.flatnonzero(np.logical_or.reduceat(ends[at], starts)).tolist() if _SPACE_AFTER_SPACE.search(texts[i])}
        after = np.ones(len(at), dtype=bool)
        after[starts] = False
        for i in odd:
            after[bounds[i]:bounds[i + 1]] = False
        used = np.zeros(len(pieces), dtype=bool)
        used[at[after]] = True
        rest = pieces.filter(pa.array(used))
        first = [odd[i][0] if i in odd else p for i, p in enumerate(pieces.take(pa.array(at[starts])).to_pylist())]
        del pieces
        if odd:
            rest = pc.unique(pa.concat_arrays([rest, _texts({p for ps in odd.values() for p in ps[1:]})]))
        known = self._rest + self._old
        where = known.where(rest)
        missing = rest.filter(pc.is_null(where))
        collecting = gc.isenabled()
        gc.disable()  # many small objects and no cycles among them
        try:
            fresh = self._learn(set(first), missing, known)
        finally:
            if collecting:
                gc.enable()
        place = np.array(pc.fill_null(where, 0))
        place[np.array(pc.is_null(where))] = len(known) + np.array(fresh.where(missing))
        again = np.unique(place[(place >= len(self._rest)) & (place < len(known))])
        self._rest = self._rest + known.take(pa.array(again)) + fresh
        # the ids of every text, laid end to end: of the distinct pieces' ids, those that its pieces name
        whole = pa.concat_arrays([known.ids, fresh.ids, _ids([b"", *map(self._first.__getitem__, first)])])
        none = len(known) + len(fresh)
        taken = np.full(len(at), none, dtype=np.int32)
        taken[after] = place[np.cumsum(used, dtype=np.int32)[at[after]] - 1]
        taken[starts] = np.arange(none + 1, len(whole))
        ids = whole.take(pa.array(taken))
        cuts = np.frombuffer(ids.buffers()[1], dtype=np.int64)[bounds].tolist()
        raw = memoryview(ids.buffers()[2])
        out = [bytes(raw[a:b]) for a, b in zip(cuts, cuts[1:])]
        if odd:
            own = dict(zip(rest.to_pylist(), whole.take(pa.array(place)).to_pylist()))
            for i, ps in odd.items():
                out[i] += b"".join([own[p] for p in ps[1:]])
        return out
