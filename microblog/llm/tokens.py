"""Ids of a public tokenizer file, as the ``tokenizers`` library gives them.

Every distinct word of a block is encoded once. A plain byte-level file (its
merges in the order of their ids) is replayed by ``bpe.MergeReplay``, several
times as fast as the library on single words; for any other file the library
itself is asked, with words joined by line ends (a line end is a match and an
id of its own) and the ids cut there again. Texts that hold one of the file's
added tokens go to the library whole, which takes those first; a caller that
wants them as plain text says so.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Sequence

import numpy as np

from .bpe import _BITS, MergeReplay
from .pieces import PieceEncoder

MAX_TOKENIZER_BYTES = 64 << 20
_CHUNK = 2048


def read_tokenizer(path: str) -> str:
    """The tokenizer file; its size, checked here, bounds what is broadcast."""
    with open(path, "rb") as f:
        data = f.read(MAX_TOKENIZER_BYTES + 1)
    if len(data) > MAX_TOKENIZER_BYTES:
        raise ValueError(f"{path}: larger than {MAX_TOKENIZER_BYTES} bytes")
    return data.decode()


class LibraryWords:
    """Pattern matches to the bytes of their ids, by the library."""

    def __init__(self, data: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_str(data)
        self._tok.encode_special_tokens = True
        line_end = self._tok.encode("\n", add_special_tokens=False).ids
        self._line_end = line_end[0] if len(line_end) == 1 else None

    def _ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self._tok.encode_batch_fast(list(texts), add_special_tokens=False)]

    def __call__(self, words: Sequence[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if w and not w[-1].isspace()] if self._line_end is not None else []
        chunks = [plain[i:i + _CHUNK] for i in range(0, len(plain), _CHUNK)]
        for chunk, ids in zip(chunks, self._ids(["\n".join([words[i] for i in c]) for c in chunks])):
            cuts = np.flatnonzero(ids == self._line_end)
            if len(cuts) != len(chunk) - 1:
                continue
            raw, start = ids.tobytes(), 0
            for i, stop in zip(chunk, [*(cuts * 4).tolist(), len(raw)]):
                out[i] = raw[start:stop]
                start = stop + 4
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._ids([words[i] for i in rest])):
            out[i] = ids.tobytes()
        return out


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level files: printable
    Latin-1 characters for themselves, the others from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def replay_of(data: str) -> MergeReplay | None:
    """The merges of a plain byte-level BPE file, None for any other."""
    spec = json.loads(data)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if (model.get("type", "BPE") != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space")
            or not split.get("use_regex", True) or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))):
        return None
    vocab = model["vocab"]
    byte_id = [0] * 256
    for letter, b in _byte_letters().items():
        if letter not in vocab:
            return None
        byte_id[b] = vocab[letter]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    result = [vocab[a + b] for a, b in merges]
    if max(vocab.values()) >> _BITS or any(x >= y for x, y in zip(result, result[1:])) or result and result[0] <= max(byte_id):
        return None
    return MergeReplay(byte_id, {(vocab[a] << _BITS) | vocab[b]: r for (a, b), r in zip(merges, result)})


class LibraryTexts:
    """Whole texts to the bytes of their ids: texts with an added token by the
    library's own rules, the others by ``plain``."""

    def __init__(self, data: str, plain: PieceEncoder):
        self._added = [t["content"] for t in json.loads(data).get("added_tokens") or () if t["content"]]
        self._data, self._plain, self._tok = data, plain, None

    def _ids(self, text: str) -> bytes:
        if self._tok is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            self._tok = Tokenizer.from_str(self._data)
        return np.array(self._tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        odd = {i for i, t in enumerate(texts) if any(a in t for a in self._added)}
        rest = iter(self._plain([t for i, t in enumerate(texts) if i not in odd]) if len(odd) < len(texts) else ())
        return [self._ids(t) if i in odd else next(rest) for i, t in enumerate(texts)]


_encoders: dict[tuple[str, str], tuple[PieceEncoder, LibraryTexts]] = {}


def encoder(data: str, pattern: str, added: bool = False) -> PieceEncoder | LibraryTexts:
    """One encoder per worker and tokenizer file. ``added``: the file's added
    tokens have their ids; without, they are text like any other."""
    key = (hashlib.sha256(data.encode()).hexdigest(), pattern)
    if key not in _encoders:
        _encoders.clear()
        plain = PieceEncoder(pattern, replay_of(data) or LibraryWords(data))
        _encoders[key] = plain, LibraryTexts(data, plain)
    return _encoders[key][added]
