"""Quality scores by Bradley-Terry ranking.

Every text becomes a vector of surface features (character classes, word
shapes, repetition). From labelled texts, pairs of a good and a bad one are
drawn; the chance that the first is preferred is the logistic function of the
difference of their scores, and the weights of the linear score minimise the
logistic loss on those feature differences (Newton's method). All texts are
scored; the threshold is the quantile of the scores of all labelled texts to
learn from at the share of bad ones among them, and the returned score puts
this threshold at ``CUT``.

What is fitted reads at most ``SAMPLE`` labelled texts of either label (those
with the smallest hash of their id) and ``PAIRS`` pairs; share and quantile
read all labelled texts to learn from.

Definitions: null is the empty text; its features are zeros. Rows with a null
id are scored, not learnt from, as are texts without a label or with a null
one; a text with several labels counts as its largest; of rows that share an id
one is learnt from. Without labels of both
kinds every score is 0.5 (kept). Ties at the quantile lie below
the threshold, unless no score is higher; then all are kept. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import blocks, column, materialise, texts_of

CUT = 0.3
SAMPLE = 4_000
PAIRS = 40_000
SHAPES = 64
RIDGE = 1e-3
_RUNS = re.compile(r"(.)\1+", re.DOTALL)


class _Shapes(dict):
    """Words to (number, length, shape): letters by case, digits, other
    characters as they are, runs as one, hashed."""

    def __init__(self):
        self.length: list[int] = []
        self.shape: list[int] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        classes = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
        self.length.append(len(word))
        self.shape.append(xxhash.xxh32_intdigest(_RUNS.sub(r"\1", classes).encode()) % SHAPES)
        return n


def features(text: str, shapes: _Shapes) -> np.ndarray:
    own = np.zeros(SHAPES + 14, dtype=np.float32)
    words = text.split()
    if not words:
        return own
    w = np.fromiter(map(shapes.__getitem__, words), dtype=np.int64, count=len(words))
    counts = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
    n = counts.sum()
    upper, lower, digits = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    other = counts[128:].sum()
    marks = counts[33:48].sum() + counts[58:65].sum() + counts[91:97].sum() + counts[123:127].sum()
    usual = counts[[44, 46]].sum()  # comma, full stop
    lines = text.split("\n")
    _, of_word = np.unique(w, return_counts=True)
    length = np.fromiter((shapes.length[i] for i in w.tolist()), dtype=np.float64, count=len(w))
    plain = (upper / max(1, upper + lower), digits / n, (marks - usual) / n, usual / n, other / n, counts[10] / n,
             float((w[1:] == w[:-1]).mean()) if len(w) > 1 else 0.0, float((w[2:] == w[:-2]).mean()) if len(w) > 2 else 0.0,
             len(of_word) / len(w), of_word.max() / len(w), 1 - len(set(lines)) / len(lines), length.mean() / 10, length.std() / 10, log(1 + len(w)) / 10)
    own[:14] = plain
    share = np.bincount(np.fromiter((shapes.shape[i] for i in w.tolist()), dtype=np.int64, count=len(w)), minlength=SHAPES) / len(w)
    own[14:] = np.sqrt(share)
    return own


def featurise(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, x) and the columns ``carry``: the feature vector of every text.
    Written once."""
    more = docs.select(*carry)
    schema = pa.schema([("id", pa.int64()), ("x", pa.list_(pa.float32())), *to_arrow_schema(more.schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text):
            shapes = _Shapes()
            yield pa.RecordBatch.from_arrays([column(b, key).cast(pa.int64()), pa.array([features(t, shapes) for t in texts_of(b, text)], pa.list_(pa.float32())), *(column(b, c) for c in carry)], schema=schema)

    ddl = ", ".join(["id bigint, x array<float>", *(f"`{c}` {t}" for c, t in more.dtypes)])
    return materialise(docs.select(*dict.fromkeys([key, text, *carry])).mapInArrow(run, ddl), "features")


def fit(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = 1):
    """Mean, scale and weights of the linear score, from preference pairs."""
    both = np.concatenate([good, bad]).astype(np.float64)
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    rng = np.random.default_rng(seed)
    d = ((good[rng.integers(len(good), size=pairs)].astype(np.float64) - bad[rng.integers(len(bad), size=pairs)]) / scale)
    w = np.zeros(d.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (p - 1) / pairs + ridge * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def scored(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", key: str = "doc_id", text: str = "text", sample: int = SAMPLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, score) and the columns ``carry`` of every row: near 1 where label 1
    is likely; ``CUT`` is the threshold. ``learn``: which ids of ``labels`` may be
    learnt from."""
    every = featurise(docs, key, text, carry)
    known = labels.where(learn & F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("y"))
    known = materialise(known.join(every.select("id").distinct(), "id", "left_semi"), "labelled")
    few = [known.where(F.col("y") == y).select("id", "y").orderBy(F.xxhash64("id"), "id").limit(sample) for y in (1, 0)]
    one = every.join(F.broadcast(few[0].union(few[1])), "id").groupBy("id", "y").agg(F.min("x").alias("x"))  # of rows that share an id one is learnt from
    got = sorted(one.collect(), key=lambda r: r.id)  # two times the sample at most
    taken = [np.array([r.x for r in got if r.y == y], dtype=np.float32) for y in (1, 0)]
    if not all(map(len, taken)):
        return every.select(F.col("id").alias(key), F.lit(0.5).alias("score"), *carry)
    mean, scale, w = fit(*taken)

    def ranked(*more: str) -> DataFrame:
        kept = every.select(*more)
        schema = pa.schema([("id", pa.int64()), ("s", pa.float64()), *to_arrow_schema(kept.schema)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = column(b, "x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(w))
                yield pa.RecordBatch.from_arrays([column(b, "id"), pa.array(((x - mean) / scale) @ w, pa.float64()), *(column(b, c) for c in more)], schema=schema)

        return every.select("id", "x", *more).mapInArrow(run, ", ".join(["id bigint, s double", *(f"`{c}` {t}" for c, t in kept.dtypes)]))

    rank = materialise(ranked(), "ranks")
    seen = rank.join(known, "id")
    share = seen.agg(F.avg(1 - F.col("y"))).first()[0]
    bar = seen.agg(F.percentile_approx("s", F.lit(float(share)), 100_000)).first()[0]
    above = seen.where(F.col("s") > bar).agg(F.min("s")).first()[0]
    bar = bar if above is None else (bar + above) / 2  # what lies at the quantile is below the threshold
    found = ranked(*carry) if carry else rank  # what is carried is written with the features alone
    return found.select(F.col("id").alias(key), (1 / (1 + F.exp(-(F.col("s") - float(bar) + log(CUT / (1 - CUT)))))).alias("score"), *carry)
