"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is its own embedding beside the sum of those of its character
n-grams, scaled by the root of their number (both hashed). Windows of ``WINDOW`` words, starting every ``STRIDE``
words and once more at the text's end, are read in both directions by gated
recurrent units; attention pools the states, a logistic unit scores the window.
A text's score is that of its worst window; every window is scored. Training
is numpy back-propagation with Adam: first all windows carry their text's label,
then a toxic text vouches only for its worst windows. Last the bias is set so
that 0.5 best separates a quarter of the sample's texts that trained nothing, by
the worst of all their windows.

Training reads at most ``SAMPLE`` labelled texts of either label (those with the
smallest hash of their id), in ``PHASES``: ``PER_TEXT`` evenly spread windows of
each, others in every phase, and in the later ones beside these the ``PER_TEXT``
worst of all its windows, which Spark scores with the network so far.

Definitions: null and empty texts have no window and score 0; a text shorter
than a window is one window of its own length. Rows with a null id are scored,
not learnt from, as are texts without a label or with a null one; a text with
several labels counts as its largest; without labels of both kinds every score
is 0. Rows that share an id are scored each, and of their texts one is learnt
from. Words of any length are read whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import blocks, column, materialise, release_shuffles, spread, texts_of

CUT = 0.5
WINDOW = 64
STRIDE = 32
SAMPLE = 1_200
PER_TEXT = 6
MIN_TEXTS = 5  # a word seen in fewer has its n-grams only
DECAY = 2e-3
HIDDEN = 8
DIM = 8
WORD_ROWS = 1 << 15
CHAR_ROWS = 1 << 15
GRAMS = (3, 6)  # lengths of character n-grams, word ends included
EPOCHS = 5
LEAST_STEPS = 150
PHASES = 5  # of equal numbers of epochs
EVEN = 0.4  # share of the epochs in which all windows carry the label
_CHUNK = 4_096
_MARKS = ".,;:!?\"'()[]"


class Words(dict):
    """Words to numbers, in the order of appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n

    def rows(self) -> WordRows:
        """What the network knows of every word, some words at a time: their
        n-grams take far more room than what is kept of them."""
        own = list(self)
        parts = [_rows(own[i:i + _CHUNK]) for i in range(0, max(1, len(own)), _CHUNK)]
        return WordRows(*map(np.concatenate, zip(*parts)))


def _rows(words: list[str]) -> WordRows:
    low = ["<" + (w.strip(_MARKS) or w) + ">" for w in words]
    size = np.fromiter(map(len, low), dtype=np.int64, count=len(low))
    word = np.fromiter((xxhash.xxh32_intdigest(w.encode()) for w in low), dtype=np.int64, count=len(low)) % WORD_ROWS
    codes = np.frombuffer("".join(low).encode("utf-32-le"), dtype="<u4").astype(np.uint32)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(codes))  # characters to the word's end
    keys = []
    of = np.repeat(np.arange(len(low)), size)
    for n in GRAMS:
        h = np.full(max(0, len(codes) - n + 1), n, dtype=np.uint32)
        for j in range(n):
            h = (h ^ codes[j:len(h) + j]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        fits = np.flatnonzero(left[:len(h)] >= n)
        keys.append(of[fits] * CHAR_ROWS + h[fits] % CHAR_ROWS)
    key, times = np.unique(np.concatenate(keys), return_counts=True)
    owner = key // CHAR_ROWS
    total = np.bincount(owner, weights=times, minlength=len(low))
    return WordRows(word, (key % CHAR_ROWS).astype(np.uint16), np.bincount(owner, minlength=len(low)), (times / np.sqrt(total[owner])).astype(np.float32))


class WordRows(NamedTuple):
    """Of every word: its embedding row, the distinct rows of its character
    n-grams (one word after the other), how many those are, and the weight of
    each: how often it occurs, over the root of the number of n-grams."""

    word: np.ndarray
    grams: np.ndarray
    size: np.ndarray
    weight: np.ndarray

    def of(self, own: np.ndarray) -> WordRows:
        """The rows of some of the words."""
        first, size = np.cumsum(self.size) - self.size, self.size[own]
        at = np.repeat(first[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return WordRows(self.word[own], self.grams[at], size, self.weight[at])


def window_starts(n: int) -> list[int]:
    """Where the windows of n words start."""
    if n <= WINDOW:
        return [0] if n else []
    starts = list(range(0, n - WINDOW + 1, STRIDE))
    return starts if starts[-1] == n - WINDOW else [*starts, n - WINDOW]


def windows(numbers: np.ndarray) -> np.ndarray:
    """The overlapping windows of a text's word numbers; -1 fills up."""
    starts = window_starts(len(numbers))
    if len(numbers) < WINDOW:
        numbers = np.concatenate([numbers, np.full(WINDOW - len(numbers), -1, dtype=numbers.dtype)])
    return numbers[np.array(starts, dtype=np.int64)[:, None] + np.arange(WINDOW)] if starts else np.empty((0, WINDOW), dtype=numbers.dtype)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _tanh(x: np.ndarray) -> np.ndarray:
    return 2 * _sigmoid(2 * x) - 1


class Network:
    """Parameters by name: ``word`` and ``char`` embeddings; for either
    direction input weights, recurrent weights and biases of the update, reset
    and candidate gates; attention; output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        some = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.p = {"word": np.zeros((WORD_ROWS, DIM), np.float32), "char": some(CHAR_ROWS, DIM)}
        for d in "fb":
            self.p |= {"W" + d: some(2 * DIM, 3 * HIDDEN), "U" + d: some(HIDDEN, 3 * HIDDEN), "c" + d: np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"A": some(2 * HIDDEN, HIDDEN), "v": some(HIDDEN), "o": some(2 * HIDDEN), "b": np.zeros(1, np.float32)}

    def inputs(self, rows: WordRows) -> np.ndarray:
        """Input vectors of words, a zero one at the end (for number -1)."""
        out = np.zeros((len(rows.word) + 1, 2 * DIM), np.float32)
        if len(rows.word):
            out[:-1, :DIM] = self.p["word"][rows.word]
            ends = np.cumsum(rows.size)
            for i in range(0, len(ends), _CHUNK):  # a word's n-grams take far more room than the word
                first, size = ends[i] - rows.size[i], rows.size[i:i + _CHUNK]
                own = slice(first, first + size.sum())
                out[i:i + len(size), DIM:] = np.add.reduceat(self.p["char"][rows.grams[own]] * rows.weight[own, None], np.cumsum(size) - size)
        return out

    def _direction(self, d: str, gates: np.ndarray, at: np.ndarray, real: np.ndarray, keep: list | None):
        """States (steps, windows, HIDDEN); ``gates``: input parts by word."""
        U, h = self.p["U" + d], np.zeros((at.shape[1], HIDDEN), np.float32)
        out = np.empty((len(at), at.shape[1], HIDDEN), np.float32)
        whole = real.all()
        for t in range(len(at)) if d == "f" else range(len(at) - 1, -1, -1):
            x, u = gates[at[t]], h @ U
            zr = _sigmoid(x[:, :2 * HIDDEN] + u[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = _tanh(x[:, 2 * HIDDEN:] + r * u[:, 2 * HIDDEN:])
            new = n + z * (h - n)
            if not whole:
                new = np.where(real[t][:, None], new, h)
            if keep is not None:
                keep.append((t, h, z, r, n, u[:, 2 * HIDDEN:]))
            h = out[t] = new
        return out

    def _pool(self, states: np.ndarray, real: np.ndarray):
        a = _tanh(states @ self.p["A"])
        e = np.where(real, a @ self.p["v"], -1e9)
        e = np.exp(e - e.max(axis=0))
        alpha = e / e.sum(axis=0)
        pooled = (alpha[:, :, None] * states).sum(axis=0)
        return a, alpha, pooled, pooled @ self.p["o"] + self.p["b"][0]

    def logits(self, x: np.ndarray, wins: np.ndarray) -> np.ndarray:
        """A logit per window of word numbers, given the words' inputs."""
        gates = [x @ self.p["W" + d] + self.p["c" + d] for d in "fb"]
        out = [np.empty(0, np.float32)]
        for i in range(0, len(wins), _CHUNK):
            at = np.ascontiguousarray(wins[i:i + _CHUNK].T)
            real = at >= 0
            states = np.concatenate([self._direction(d, g, at, real, None) for d, g in zip("fb", gates)], axis=2)
            out.append(self._pool(states, real)[3])
        return np.concatenate(out)

    def gradients(self, rows: WordRows, wins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted logistic loss over a batch of windows."""
        used, at = np.unique(wins, return_inverse=True)
        at = at.reshape(wins.shape).T - (used[0] < 0)  # -1 stays -1
        rows = rows.of(used[used >= 0])
        x, real, g = self.inputs(rows), at >= 0, {}
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._direction(d, x @ self.p["W" + d] + self.p["c" + d], at, real, kept[d]) for d in "fb"], axis=2)
        a, alpha, pooled, logit = self._pool(states, real)
        dl = ((_sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g["b"], g["o"] = dl.sum(keepdims=True), pooled.T @ dl
        dp = dl[:, None] * self.p["o"]
        da = (states * dp).sum(axis=2)
        de = alpha * (da - (alpha * da).sum(axis=0))
        g["v"] = np.einsum("tbh,tb->h", a, de)
        dt = de[:, :, None] * self.p["v"] * (1 - a * a)
        g["A"] = np.einsum("tbs,tbh->sh", states, dt)
        ds = alpha[:, :, None] * dp + dt @ self.p["A"].T
        dx = np.zeros_like(x)
        for k, d in enumerate("fb"):
            U, dU = self.p["U" + d], np.zeros_like(self.p["U" + d])
            dgates, each = np.zeros((len(x), 3 * HIDDEN), np.float32), np.empty((len(at), wins.shape[0], 3 * HIDDEN), np.float32)
            dh = np.zeros((wins.shape[0], HIDDEN), np.float32)
            for t, h, z, r, n, un in reversed(kept[d]):
                live = real[t][:, None]
                dnew = dh + ds[t][:, k * HIDDEN:(k + 1) * HIDDEN]
                dn = np.where(live, dnew * (1 - z) * (1 - n * n), 0)
                dz = np.where(live, dnew * (h - n) * z * (1 - z), 0)
                dr = dn * un * r * (1 - r)
                du = np.concatenate([dz, dr, dn * r], axis=1)
                each[t] = np.concatenate([dz, dr, dn], axis=1)
                dU += h.T @ du
                dh = np.where(live, dnew * z, dnew) + du @ U.T
            np.add.at(dgates, at.ravel(), each.reshape(-1, 3 * HIDDEN))
            dgates[-1] = 0
            g["U" + d], g["W" + d], g["c" + d] = dU, x.T @ dgates, dgates.sum(axis=0)
            dx += dgates @ self.p["W" + d].T
        g["word"], g["char"] = np.zeros_like(self.p["word"]), np.zeros_like(self.p["char"])
        np.add.at(g["word"], rows.word, dx[:-1, :DIM])
        np.add.at(g["char"], rows.grams, np.repeat(dx[:-1, DIM:], rows.size, axis=0) * rows.weight[:, None])
        return g


class Sample(NamedTuple):
    """Windows to learn from: the label of each text, which text each window is
    of (ascending), the windows as word numbers, and those words' rows."""

    label: np.ndarray
    owner: np.ndarray
    wins: np.ndarray
    rows: WordRows


class Trainer:
    """Adam on a network; ``fit`` is called with the windows of each phase."""

    def __init__(self, seed: int = 7):
        self.net, self.rng, self.step = Network(seed), np.random.default_rng(seed), 0
        self.m = {k: np.zeros_like(v) for k, v in self.net.p.items()}
        self.s = {k: np.zeros_like(v) for k, v in self.net.p.items()}

    def fit(self, sample: Sample, first: float, last: float, epochs: int = EPOCHS, batch: int = 256, rate: float = 0.01) -> None:
        """The epochs from share ``first`` to ``last`` of all."""
        net, m, s = self.net, self.m, self.s
        owner, wins, known = sample.owner, sample.wins, sample.rows
        label = sample.label[owner].astype(np.float32)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        row = np.append(known.word, WORD_ROWS)[wins]  # -1, what fills up, is a row of its own
        seen = np.unique(np.repeat(owner, WINDOW) * (WORD_ROWS + 1) + row.ravel())
        own_row = np.bincount(seen % (WORD_ROWS + 1), minlength=WORD_ROWS + 1)[:WORD_ROWS] >= MIN_TEXTS
        del row, seen
        epochs = max(epochs, -(-LEAST_STEPS // max(1, -(-len(wins) // batch))))  # few windows are seen more often
        for epoch in range(epochs):
            if not first * epochs <= epoch < last * epochs:
                continue
            use = np.ones(len(wins), dtype=bool)
            if epoch >= epochs * EVEN:  # a toxic text's windows that look clean beside its worst one prove nothing
                now = net.logits(net.inputs(known), wins)
                worst = np.maximum.reduceat(now, starts)
                use = (label == 0) | (now >= np.minimum(np.repeat(worst, np.diff(np.append(starts, len(wins)))), 1.0))
            at = self.rng.permutation(np.flatnonzero(use))
            balance = np.where(label == 1, (label[at] == 0).sum() / max(1, (label[at] == 1).sum()), 1.0).clip(0.2, 4)
            for i in range(0, len(at), batch):
                own = at[i:i + batch]
                self.step += 1
                for k, g in net.gradients(known, wins[own], label[own], balance[own]).items():
                    if k == "word":
                        g[~own_row] = 0
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.001 * (g * g - s[k])
                    net.p[k] -= (rate * (0.3 if epoch >= epochs * 0.6 else 1) * (m[k] / (1 - 0.9 ** self.step)) / (np.sqrt(s[k] / (1 - 0.999 ** self.step)) + 1e-8)).astype(np.float32)
                    if k in ("word", "char"):
                        net.p[k] *= 1 - DECAY


def set_bias(net: Network, worst: np.ndarray, y: np.ndarray, weights: tuple[float, float]) -> None:
    """0.5 best separates texts with these worst logits and labels; ``weights``:
    how many texts one of label 0 and one of label 1 stand for."""
    if 0 < y.sum() < len(y):
        order = np.argsort(worst)
        wrong = weights[0] * (y == 0).sum() + np.concatenate([[0], np.cumsum(np.where(y[order] == 1, weights[1], -weights[0]))])  # texts below the cut count as clean
        ends = np.concatenate([[worst[order[0]] - 1], worst[order], [worst[order[-1]] + 1]])
        best = np.flatnonzero(wrong <= wrong.min() + 1e-9)
        mid = int(best[len(best) // 2])
        net.p["b"] -= (ends[mid] + ends[mid + 1]) / 2


def _logits(net: Network, texts: list[list[str]]) -> list[np.ndarray]:
    """The logits of all windows of each text."""
    words = Words()
    own = [windows(np.fromiter(map(words.__getitem__, t), dtype=np.int32, count=len(t))) for t in texts]
    found = net.logits(net.inputs(words.rows()), np.concatenate(own)).astype(np.float64)
    return np.split(found, np.cumsum([len(w) for w in own])[:-1])


def _sampled(docs: DataFrame, labels: DataFrame, learn: Column, label: str, key: str, text: str, sample: int):
    """The texts to learn from (y, aside, text, print), whose number the
    parameter bounds, and how many labelled texts there are by label. Of rows
    that share an id the text with the smallest hash is taken."""
    known = labels.where(learn & F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    known = known.join(docs.select(key).distinct(), key, "left_semi")
    there = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    few = known.where("y = 1").orderBy(F.xxhash64(key), key).limit(sample).union(known.where("y = 0").orderBy(F.xxhash64(key), key).limit(sample))
    few = few.withColumn("turn", F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64(key), key)))
    rows = docs.where(F.col(key).isNotNull()).select(key, text).join(F.broadcast(few), key)
    rows = rows.groupBy(key, "y", "turn").agg(F.min(F.struct(F.xxhash64(text).alias("print"), F.col(text).alias("text"))).alias("one"))
    aside = F.col("turn") % 4 == 0  # of either label; sets the bias, trains nothing
    return materialise(rows.select("y", aside.alias("aside"), "one.text", "one.print"), "sample"), there


def _picked(rows: DataFrame, net: Broadcast | None, shift: float = 0.0) -> Sample:
    """Windows of each text: some evenly spread, ``shift`` steps on, and, given a
    network, the worst of all. Tasks send numbers, no words: the windows of a
    block as numbers of its words, and of each word its hash and its rows."""
    names = ("y", "print", "count", "wins", "hash", "word", "grams", "size", "weight")
    types = dict(zip(names, (np.int32, np.int64, np.int32, np.int32, np.uint64, np.int32, np.uint16, np.int32, np.float32)))
    schema = pa.schema([(c, pa.binary()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            texts = [t.lower().split() for t in texts_of(b)]
            logits = _logits(net.value, texts) if net else [np.empty(0)] * len(texts)
            words, wins, count = Words(), [np.empty((0, WINDOW), np.int32)], []
            for own, z in zip(texts, logits):
                starts = window_starts(len(own))
                even = min(PER_TEXT, len(starts))
                pick = {int((i + shift) * len(starts) / even) for i in range(even)}
                pick |= set(np.argsort(-z, kind="stable")[:PER_TEXT].tolist())
                for i in sorted(pick):
                    win = own[starts[i]:starts[i] + WINDOW]
                    wins.append(np.array([[*map(words.__getitem__, win), *[-1] * (WINDOW - len(win))]], np.int32))
                count.append(len(pick))
            known = words.rows()
            values = (column(b, "y").to_numpy(), column(b, "print").to_numpy(), count, np.concatenate(wins), [xxhash.xxh3_64_intdigest(w.encode()) for w in words], *known)
            yield pa.RecordBatch.from_arrays([pa.array([np.asarray(x).astype(types[c]).tobytes()], pa.binary()) for c, x in zip(names, values)], schema=schema)

    got = rows.mapInArrow(run, ", ".join(f"{c} binary" for c in names)).collect()  # bounded by the sample's texts
    parts = {c: [np.frombuffer(r[c], types[c]) for r in got] for c in names}
    del got
    base = np.cumsum([0] + [len(x) for x in parts["hash"]])
    wins = [np.where(w >= 0, w + n, -1) for w, n in zip(parts["wins"], base)]
    parts["wins"] = wins
    whole = {c: np.concatenate(x) if (x := parts.pop(c)) else np.empty(0, types[c]) for c in names}
    _, first, number = np.unique(whole["hash"], return_index=True, return_inverse=True)  # words of several tasks are one
    known = WordRows(whole["word"], whole.pop("grams"), whole["size"], whole.pop("weight")).of(first)
    wins = np.append(number, -1)[whole["wins"].reshape(-1, WINDOW)]
    order = np.lexsort((whole["print"], whole["y"]))  # the same whatever task had which text
    order = order[whole["count"][order] > 0]
    starts, count = np.cumsum(whole["count"]) - whole["count"], whole["count"][order]
    at = np.repeat(starts[order] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return Sample(whole["y"][order], np.repeat(np.arange(len(order)), count), wins[at], known)


def _worst(rows: DataFrame, net: Broadcast) -> list[tuple[int, float]]:
    """Label and highest logit of each text, over all its windows."""
    schema = pa.schema([("y", pa.int32()), ("worst", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, "text"):
            worst = [z.max() if len(z) else None for z in _logits(net.value, [t.lower().split() for t in texts_of(b)])]
            yield pa.RecordBatch.from_arrays([column(b, "y").cast(pa.int32()), pa.array(worst, pa.float64())], schema=schema)

    return sorted((r.y, r.worst) for r in rows.mapInArrow(run, "y int, worst double").collect() if r.worst is not None)


def learnt(rows: DataFrame, there: dict[int, int]) -> Network | None:
    """The network trained on a sample; none without texts of both labels."""
    context = rows.sparkSession.sparkContext
    inside, aside = spread(rows.where("not aside")), spread(rows.where("aside"))
    trainer = Trainer()
    for phase in range(PHASES):
        shift, sample = phase / PHASES, None  # the last phase's windows go before the next ones come
        sample = _picked(inside, None if shift < EVEN else context.broadcast(trainer.net), shift)
        if len(set(sample.label.tolist())) < 2:
            return None
        release_shuffles(rows.sparkSession)  # the driver trains beside its JVM
        trainer.fit(sample, shift, (phase + 1) / PHASES)
    del sample
    worst = _worst(aside, context.broadcast(trainer.net))
    taken = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    weights = tuple(there[y] / taken[y] for y in (0, 1))
    set_bias(trainer.net, np.array([z for _, z in worst]), np.array([y for y, _ in worst]), weights)
    return trainer.net


def scored(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", key: str = "doc_id", text: str = "text", sample: int = SAMPLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, score) and the columns ``carry`` of every row: the score of the
    worst window, toxic from 0.5 on. ``learn``: which ids of ``labels`` may be
    learnt from."""
    found = learnt(*_sampled(docs, labels, learn, label, key, text, sample))
    if found is None:
        return docs.select(F.col(key).cast("bigint").alias(key), F.lit(0.0).alias("score"), *carry)
    net = docs.sparkSession.sparkContext.broadcast(found)  # its size is that of the parameters
    more = docs.select(*carry)
    schema = pa.schema([(key, pa.int64()), ("score", pa.float64()), *to_arrow_schema(more.schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text):
            logits = _logits(net.value, [t.lower().split() for t in texts_of(b, text)])
            score = np.array([_sigmoid(z.max()) if len(z) else 0.0 for z in logits])
            yield pa.RecordBatch.from_arrays([column(b, key).cast(pa.int64()), pa.array(score, pa.float64()), *(column(b, c) for c in carry)], schema=schema)

    ddl = ", ".join([f"`{key}` bigint, score double", *(f"`{c}` {t}" for c, t in more.dtypes)])
    return docs.select(*dict.fromkeys([key, text, *carry])).mapInArrow(run, ddl)
