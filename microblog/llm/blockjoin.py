"""Nearest neighbours by a block matrix join.

For a group of queries and a group of candidates (``tiles``), int8 products of
whole tiles give approximate inner products, and the norms of what quantising
took off give a bound on their error: |<q,c> - <q',c'>| <= |q-q'||c'| + |q||c-c'|.
Pairs whose upper bound reaches the k-th best so far are recomputed in double
precision on the original vectors; a heap per query keeps the best k, and its
smallest score is the bar for the tiles after it. The bounds are exact, so the
result is too (recall 1). Equal vectors are compared once.

Ties go to the smaller id; zero vectors take no part (see ``tiles`` for the
other cases).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from .tiles import nearest

TILE = 2_048


def quantise(x: np.ndarray):
    """int8 vectors, their scales, the norms of what they stand for and of the
    remainders."""
    scale = np.abs(x).max(axis=1, keepdims=True) / 127
    whole = np.rint(x / scale)
    near = whole * scale
    return whole.astype(np.int8), scale[:, 0], np.sqrt((near * near).sum(axis=1)), np.sqrt(((x - near) ** 2).sum(axis=1))


def best_of(q: np.ndarray, q_rows: np.ndarray, vecs: np.ndarray, holders: list, k: int) -> Iterator[tuple[int, int, float]]:
    exact = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64  # sums of int8 products are whole in it
    qi, qs, q_near, q_off = quantise(q)
    qi = qi.astype(exact)
    q_norm = np.sqrt((q * q).sum(axis=1))
    heaps: list[list] = [[] for _ in range(len(q))]
    bar = np.full(len(q), -np.inf)
    for start in range(0, len(vecs), TILE):
        c = vecs[start:start + TILE]
        ci, cs, c_near, c_off = quantise(c)
        about = (qi @ ci.astype(exact).T).astype(np.float64) * qs[:, None] * cs
        slack = np.outer(q_off, c_near) + np.outer(q_norm, c_off) + 1e-9 * np.outer(q_norm, c_near + c_off)
        if len(c) > k + 1:  # one of the best may be the query itself
            low = np.partition(about - slack, len(c) - k - 1, axis=1)[:, len(c) - k - 1]
            bar = np.maximum(bar, low)
        for i, js in enumerate(map(np.flatnonzero, about + slack >= bar[:, None])):
            if not len(js):
                continue
            heap, own = heaps[i], q_rows[i]
            for j, s in zip(js.tolist(), (c[js] * q[i]).sum(axis=1).tolist()):
                for vec_id, row in zip(*holders[start + j]):
                    if row == own:
                        continue
                    if len(heap) < k:
                        heapq.heappush(heap, (s, -vec_id))
                    elif (s, -vec_id) > heap[0]:
                        heapq.heapreplace(heap, (s, -vec_id))
                    else:
                        break
            if len(heap) == k:
                bar[i] = max(bar[i], heap[0][0])
    for i, heap in enumerate(heaps):
        for s, negative in heap:
            yield i, -negative, s


def search(df: DataFrame, divisor: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding", **sizes) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of the largest inner product
    for every row whose id is divisible by ``divisor``."""
    return nearest(df, divisor, k, best_of, "double", key, vector, zero=False, **sizes)
