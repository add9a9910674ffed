"""Exact top-k by KD-trees per shard.

A group's candidates (``tiles``) are cut into shards, each with a KD-tree:
median splits of the widest dimension down to leaves, and a tight bounding box
at every node. The largest inner product that a query can have with a box is
the sum over dimensions of the better of its two corners. A query goes through
a tree best box first and stops when the best box left cannot reach its k-th
score, which it carries on from shard to shard. Scores are integers, so nothing
is rounded. Equal vectors are kept once.

Components x become floor(scale * x) of the double x. Ties go to the smaller
id; zero vectors take part with score 0 (see ``tiles`` for the other cases).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tiles import nearest

SHARD = 8_192
LEAF = 256


class Tree:
    """Median splits with tight boxes; ``points`` of each leaf."""

    def __init__(self, vecs: np.ndarray, leaf: int = LEAF):
        self.low, self.high, self.children, self.points = [], [], [], []
        self._grow(vecs, np.arange(len(vecs)), leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, vecs: np.ndarray, at: np.ndarray, leaf: int) -> int:
        own = vecs[at]
        node = len(self.children)
        self.low.append(own.min(axis=0))
        self.high.append(own.max(axis=0))
        self.children.append(None)
        self.points.append(at)
        if len(at) > leaf:
            wide = int(np.argmax(self.high[node] - self.low[node]))
            order = np.argpartition(own[:, wide], len(at) // 2)
            half = len(at) // 2
            self.points[node] = None
            self.children[node] = (self._grow(vecs, at[order[:half]], leaf), self._grow(vecs, at[order[half:]], leaf))
        return node

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """The most that each query can score in each node."""
        return np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T


def best_of(q: np.ndarray, q_rows: np.ndarray, vecs: np.ndarray, holders: list, k: int) -> Iterator[tuple[int, int, int]]:
    heaps: list[list] = [[] for _ in range(len(q))]
    for start in range(0, len(vecs), SHARD):
        shard = vecs[start:start + SHARD]
        tree = Tree(shard)
        bounds = tree.bounds(q)
        for i, heap in enumerate(heaps):
            own, bound = q_rows[i], bounds[i].tolist()
            todo = [(-bound[0], 0)]
            while todo:
                top, node = heapq.heappop(todo)
                if len(heap) == k and -top < heap[0][0]:
                    break
                if tree.children[node]:
                    for child in tree.children[node]:
                        heapq.heappush(todo, (-bound[child], child))
                    continue
                at = tree.points[node]
                scores = shard[at] @ q[i]
                if len(heap) == k:
                    reach = np.flatnonzero(scores >= heap[0][0])
                    at, scores = at[reach], scores[reach]
                for j, s in zip(at.tolist(), scores.tolist()):
                    for vec_id, row in zip(*holders[start + j]):
                        if row == own:
                            continue
                        if len(heap) < k:
                            heapq.heappush(heap, (s, -vec_id))
                        elif (s, -vec_id) > heap[0]:
                            heapq.heapreplace(heap, (s, -vec_id))
                        else:
                            break
    for i, heap in enumerate(heaps):
        for s, negative in heap:
            yield i, -negative, int(s)


def search(df: DataFrame, divisor: int = 50, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding", **sizes) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of the largest integer inner
    product for every row whose id is divisible by ``divisor``."""
    whole = df.withColumn(vector, F.transform(F.col(vector), lambda x: F.when(F.isnan(x) | (F.abs(x) == float("inf")), x.cast("double")).otherwise(F.floor(x.cast("double") * scale).cast("double"))))
    return nearest(whole, divisor, k, best_of, "bigint", key, vector, zero=True, **sizes)
