"""Centroid clustering with a vantage-point tree over the centroids.

Every round builds a vantage-point tree of the current centroids on the driver
and broadcasts it (its size is that of ``k`` vectors, a parameter). Tasks search
it for all vectors of a block at once, each with a frontier of its own: the
vector's most promising subtree is opened next, until its lower bound exceeds
the best distance so far. The pruning radius is inclusive, bounds are taken a
little too low, and distances are exact integers, so that of equally near
centroids the smaller number always wins. Component sums leave a task once, at
its end, and Spark adds them up; only ``k`` times the components reach the
driver.

Definitions: vectors are kept that have an id, the given number of components
and none null, non-finite or of a magnitude of ``LARGEST`` or more (squared
distances of what is kept fit 64 bits); no other rows come back. A component x
becomes floor(scale * x). The first centroids are the kept vectors with the
smallest hashes of their ids (then components); fewer vectors than ``k``
make as many clusters. Rows that share an id are vectors of their own. Empty
clusters keep their centroid. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialise

K = 8
ROUNDS = 10
DIMENSIONS = 64
SCALE = 1024
LARGEST = 1 << 16
LEAF = 2  # centroids in a leaf, at most
BLOCK = 4_096  # vectors searched at once
_SLACK = 1e-12  # share of the distances by which bounds are taken too low, against rounding


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to a point."""
    gap = vectors - point
    return np.einsum("ij,ij->i", gap, gap)


class VantageTree:
    """Nodes in flat arrays. A node has a vantage point and two children, each
    with the least and largest distance of its points from the vantage point, or
    is a leaf with the numbers of its points."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.vantage: list[int] = []
        self.kids: list[list[tuple[int, float, float]]] = []  # child, least, largest distance
        self.leaf: list[list[int]] = []
        if len(points):
            self._grow(list(range(len(points))))

    def _grow(self, members: list[int]) -> int:
        at = len(self.kids)
        self.vantage.append(-1)
        self.kids.append([])
        self.leaf.append([])
        if len(members) <= LEAF:
            self.leaf[at] = members
            return at
        center = self.points[members].mean(axis=0)
        far = np.argmax(((self.points[members] - center) ** 2).sum(axis=1))  # a point at the rim parts the others best
        own = members[int(far)]
        rest = np.array([m for m in members if m != own])
        away = np.sqrt(squared(self.points[rest], self.points[own]).astype(np.float64))
        order = np.argsort(away, kind="stable")
        self.vantage[at] = own
        for half in np.array_split(order, 2):
            if len(half):
                self.kids[at].append((self._grow(sorted(rest[half].tolist())), float(away[half].min()), float(away[half].max())))
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest point (the smaller of equals) and its squared
        distance, for every vector; and how many distances were computed."""
        n = len(vectors)
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.points), np.int64)
        bound, node = np.zeros((n, 1)), np.zeros((n, 1), np.int64)  # the frontiers
        live, asked = np.arange(n), 0
        while len(live):
            pick = bound[live].argmin(axis=1)
            least = bound[live, pick]
            go = least <= np.sqrt(best[live].astype(np.float64))  # inclusive; an empty frontier has an infinite bound
            live, pick = live[go & np.isfinite(least)], pick[go & np.isfinite(least)]
            opened = node[live, pick]
            bound[live, pick] = np.inf
            for at in np.unique(opened):
                own = live[opened == at]
                for c in self.leaf[at] or [self.vantage[at]]:
                    away = squared(vectors[own], self.points[c])
                    asked += len(own)
                    closer = (away < best[own]) | (away == best[own]) & (c < number[own])
                    best[own[closer]], number[own[closer]] = away[closer], c
                if self.kids[at]:
                    away = np.sqrt(away.astype(np.float64))
                for kid, low, high in self.kids[at]:
                    lower = np.maximum(0, np.maximum(low - away, away - high) - _SLACK * (away + high))
                    free = np.isinf(bound[own])
                    if not free.any(axis=1).all():
                        bound = np.hstack([bound, np.full((n, 1), np.inf)])
                        node = np.hstack([node, np.zeros((n, 1), np.int64)])
                        free = np.isinf(bound[own])
                    slot = free.argmax(axis=1)
                    bound[own, slot], node[own, slot] = lower, kid
        return number, best, asked


def kept(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part, as integers."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    rows = vectors.where(F.col(key).isNotNull() & (F.size(v) == dimensions) & fine)
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return rows.select(F.col(key).cast("bigint").alias("vec_id"), whole.alias("v"))


def first_centroids(rows: DataFrame, k: int = K, salt: str = "3:") -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of salt and id."""
    first = rows.orderBy(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256), "v").limit(k)
    return np.array([r.v for r in first.collect()], dtype=np.int64)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    v = column(batch, "v").flatten().to_numpy().astype(np.int64)
    return v.reshape(batch.num_rows, len(v) // max(1, batch.num_rows))


def _moved(rows: DataFrame, tree: Broadcast, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: exact floors of the clusters' means."""
    schema = pa.schema([("cluster", pa.int32()), ("part", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tree.value
        total, n = np.zeros_like(t.points), np.zeros(len(t.points), np.int64)
        for b in batches:
            all_v = _matrix(b)
            for v in np.split(all_v, range(BLOCK, len(all_v), BLOCK)):
                own = t.nearest(v)[0]
                np.add.at(total, own, v)
                n += np.bincount(own, minlength=len(n))
        cluster, part = np.divmod(np.arange(total.size, dtype=np.int32), total.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(cluster.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array(total.ravel()), pa.array(n[cluster])], schema=schema)

    sums = rows.mapInArrow(run, "cluster int, part int, total bigint, n bigint").groupBy("cluster", "part")
    sums = sums.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).where("n > 0")
    out = centroids.copy()
    for r in sums.collect():  # centroids times components
        out[r.cluster, r.part] = int(r.total) // r.n
    return out


def _assigned(rows: DataFrame, tree: Broadcast) -> DataFrame:
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                own, away, _ = tree.value.nearest(_matrix(part))
                yield pa.RecordBatch.from_arrays([column(part, "vec_id"), pa.array(own.astype(np.int32)), pa.array(away)], schema=schema)

    return rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def fit(rows: DataFrame, k: int = K, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after ``rounds`` rounds over what ``kept`` gives."""
    context = rows.sparkSession.sparkContext
    centroids = first_centroids(rows, k)
    for _ in range(rounds if len(centroids) else 0):
        tree = context.broadcast(VantageTree(centroids))
        centroids = _moved(rows, tree, centroids)
        tree.destroy()
    return centroids


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256,
    centroid) of every vector kept."""
    spark = vectors.sparkSession
    rows = materialise(kept(vectors, dimensions, scale, key, vector), "vectors")
    centroids = fit(rows, k, rounds)
    out = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string, centroid array<bigint>"
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id bigint, distance bigint, {out}").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")
    found = materialise(_assigned(rows, spark.sparkContext.broadcast(VantageTree(centroids))), "assigned")
    sums = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    every = [(i, sums[i], sum(sums.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest(), c.tolist()) for i, c in enumerate(centroids) if i in sums]
    return found.join(F.broadcast(spark.createDataFrame(every, out)), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")
