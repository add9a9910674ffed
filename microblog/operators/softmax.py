"""Softmax regression on the vocabulary index.

The model is a table: a row per vocabulary index with a weight for each class
(the padding index, which no text has, carries the intercepts). The features of
an example are one row (``feats``: indices and values); for a fit they are packed
into blocks of many examples, sorted by index, as binary columns that Arrow hands
to numpy as they are. A step of full-batch gradient descent with momentum is one
pass over the blocks and an aggregate per index. Frequent tokens have small
indices, so the head of the table (of a fixed size) is broadcast and moved by the
driver; rare tokens' weights lie in buckets, are handed to a block by a join and
are moved by another. Blocks and these weights are dealt once and no step moves
them.

The penalty is chosen on an inner split of the training examples (by a seeded
hash of the id): all candidates are trained side by side in the same passes,
then the best one on all training examples. Held-out examples play no part.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.labels import BAD_INPUT
from . import vocab as V
from .common import as_lists, column, lists, mapped, stored
from .prep import shuffle_key

# Fixed value: number of sentiment classes.
CLASSES = 3
BIAS = V.PAD_IDX

# Weights of at most this many indices are broadcast (18 numbers
# each while penalties are compared), and the features a bucket should have at
# most.
HEAD_ROWS = 500_000
PART_ROWS = 1 << 24
MERGE_ROWS = 10_000  # single features of the head that are left as they are
PARTITIONS = "spark.sql.shuffle.partitions"

# Features of a block, rows of a batch that a step hands on, and row groups that hold
# a few blocks only.
BLOCK_ROWS = 1 << 17
OUT_ROWS = 10_000
SMALL_GROUPS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "4", "parquet.block.size.row.check.min": "4"}

# Examples whose seeded hash starts below this choose the penalty: 0.2 of the
# range of four hexadecimal digits.
INNER_BELOW = "3333"


@dataclass(frozen=True)
class Params:
    steps: int = 12
    rate: float = 2.0
    momentum: float = 0.8
    penalties: tuple[float, ...] = (0.0, 0.001, 0.01)
    seed: int = 42


FEATS = "feats ARRAY<STRUCT<idx: BIGINT, x: DOUBLE>>"


def _feats(values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, indices and values of a column ``feats``."""
    sizes, flat = lists(values)
    return sizes, flat.field("idx").to_numpy(), flat.field("x").to_numpy()


def _as_feats(sizes: np.ndarray, idx: np.ndarray, x: np.ndarray) -> pa.Array:
    return as_lists(sizes, pa.StructArray.from_arrays([pa.array(idx, pa.int64()), pa.array(x, pa.float64())], ["idx", "x"]))


def _by_row_and_index(rows: np.ndarray, idx: np.ndarray) -> np.ndarray:
    return np.lexsort((idx, rows)) if len(idx) else np.empty(0, np.int64)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new key begins in sorted keys."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _bags(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """The other columns and ``feats``: token counts scaled to length 1, and 1 for
    the bias."""
    kept = [c for c in encoded.columns if c != ids]
    schema = StructType([*[encoded.schema[c] for c in kept], *StructType.fromDDL(FEATS)])

    def bags(batches):
        for batch in batches:
            sizes, flat = lists(column(batch, ids))
            n = len(sizes)
            rows = np.concatenate([np.repeat(np.arange(n), sizes), np.arange(n)])
            idx = np.concatenate([flat.to_numpy(zero_copy_only=False).astype(np.int64), np.full(n, BIAS)])
            order = _by_row_and_index(rows, idx)
            rows, idx = rows[order], idx[order]
            at = _starts(rows, idx)
            c = np.diff(np.append(at, len(idx))).astype(float)
            rows, idx = rows[at], idx[at]
            bias = idx == BIAS
            squares = np.bincount(rows, weights=np.where(bias, 0.0, c * c), minlength=n)
            x = np.where(bias, 1.0, c / np.sqrt(np.where(squares > 0, squares, 1.0))[rows])
            columns = [column(batch, k) for k in kept]
            yield pa.RecordBatch.from_arrays([*columns, _as_feats(np.bincount(rows, minlength=n), idx, x)], [*kept, "feats"])

    return mapped(encoded, bags, schema)


def features(encoded: DataFrame, id_col: str = "id") -> DataFrame:
    """id, idx, x: token counts scaled to length 1, and 1 for the bias."""
    return _apart(_bags(encoded.select(id_col, "ids")), id_col)


def _apart(bags: DataFrame, *kept: str) -> DataFrame:
    return bags.select(*kept, F.explode("feats").alias("_f")).select(*kept, "_f.idx", "_f.x")


def _gathered(rows: DataFrame, *by: str) -> DataFrame:
    """Features as a row per example: (by, feats)."""
    if "feats" in rows.columns:
        return rows
    return rows.groupBy(*by).agg(F.collect_list(F.struct(F.col("idx").cast("bigint").alias("idx"), F.col("x").cast("double").alias("x"))).alias("feats"))


def _near() -> Column:
    """Is the index in the head of the weights, which may be broadcast?"""
    return F.col("idx") < V.FIRST_REAL_IDX + HEAD_ROWS


def _softmax(scores: list[Column]) -> list[Column]:
    top = F.greatest(*scores)
    each = [F.exp(s - top) for s in scores]
    total = each[0]
    for e in each[1:]:
        total = total + e
    return [e / total for e in each]


def _names_of(kind: str, penalties: tuple[float, ...]) -> list[str]:
    return [c for r in range(len(penalties)) for c in _names(kind, r)]


def _names(kind: str, r: int) -> list[str]:
    return [f"{kind}{r}_{k}" for k in range(CLASSES)]


class _Layout:
    """Features as a fit reads them: ``docs`` (id, label, feats) is bucketed by id,
    ``far`` (idx) tells of features beyond the head (None: there are none).

    Features that occur in a single row get weights that are multiples of one
    another: those of an example stand in ``docs`` as one feature under the
    smallest of their indices, and ``alone`` (idx, as_idx, share) says how much of
    its weight each has. In the head this is done where there are many of them:
    most words of a corpus occur once, and every step hands on its weights. Buckets
    are a few large ones, as every task of a step hands on a sum for each index
    that it saw; tables last until ``drop``. ``rows``: id, label and feats, or a
    feature a row (id, label, idx, x)."""

    def __init__(self, rows: DataFrame):
        self.spark = rows.sparkSession
        rows = _gathered(rows, "id", "label").select("id", "label", "feats")
        size = rows.agg(F.sum(F.size("feats"))).first()[0] or 0
        self.parts = max(self.spark.sparkContext.defaultParallelism, -(-size // PART_ROWS))
        self.tables: list[str] = []
        self.far, self.alone = None, None
        with self.partitions():
            each = _apart(rows, "id", "label")
            first = [F.min(F.struct("id", "label", "x")).alias("_v")]
            counted = each.where(F.col("idx") != BIAS).groupBy("idx").agg(F.count(F.lit(1)).alias("_n"), *first)
            once = stored(counted.where("_n = 1").select("_v.id", "_v.label", "idx", "_v.x"), "single-features")
            if once.where(_near()).limit(MERGE_ROWS + 1).count() <= MERGE_ROWS:
                once = once.where(~_near())
            docs = rows.repartition(self.parts, "id").groupBy("id", "label").agg(F.flatten(F.collect_list("feats")).alias("feats"))
            if not once.isEmpty():
                own = Window.partitionBy("id", "label")
                alone = once.select("id", "label", "idx", F.min("idx").over(own).alias("as_idx"), "x", F.sqrt(F.sum(F.col("x") * F.col("x")).over(own)).alias("norm"))
                alone = stored(alone, "alone")
                self.alone = alone.select("idx", "as_idx", (F.col("x") / F.col("norm")).alias("share"))
                gone = alone.groupBy("id", "label").agg(F.collect_list("idx").alias("_gone"), F.min("as_idx").alias("_as"), F.min("norm").alias("_norm"))
                on = F.col("d.id").eqNullSafe(F.col("g._id")) & F.col("d.label").eqNullSafe(F.col("g._label"))
                gone = gone.withColumnsRenamed({"id": "_id", "label": "_label"})
                docs = _merged(docs.alias("d").join(gone.alias("g"), on, "left").select("d.*", "_gone", "_as", "_norm"))
            self.docs = self.bucketed(docs, "id")
            far = self.docs.select(F.explode("feats.idx").alias("idx")).where(~_near())
            self.far = None if far.isEmpty() else far

    @contextmanager
    def partitions(self):
        """Shuffles inside are dealt as the buckets are; the session's own setting
        comes back afterwards."""
        before = self.spark.conf.get(PARTITIONS)
        self.spark.conf.set(PARTITIONS, str(self.parts))
        try:
            yield
        finally:
            self.spark.conf.set(PARTITIONS, before)

    def bucketed(self, df: DataFrame, key: str) -> DataFrame:
        name = f"softmax_{uuid.uuid4().hex}"
        self.tables.append(name)
        df.repartition(self.parts, key).write.options(**SMALL_GROUPS).bucketBy(self.parts, key).format("parquet").saveAsTable(name)
        return self.spark.table(name)

    def drop_at(self, begin: int, end: int) -> None:
        for name in self.tables[begin:end]:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        del self.tables[begin:end]

    def drop(self, keep: int = 0) -> None:
        while len(self.tables) > keep:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop()}")


def _merged(docs: DataFrame) -> DataFrame:
    """``docs`` with the features ``_gone`` of an example as one of index ``_as``
    and value ``_norm``."""
    kept = ["id", "label"]
    schema = StructType([*[docs.schema[c] for c in kept], *StructType.fromDDL(FEATS)])

    def merge(batches):
        for batch in batches:
            get = lambda c: column(batch, c)
            sizes, idx, x = _feats(get("feats"))
            lost, flat = lists(get("_gone"))
            n = len(sizes)
            one, one_x = get("_as").fill_null(-1).to_numpy(), get("_norm").fill_null(0.0).to_numpy()
            rows, gone = np.repeat(np.arange(n), sizes), flat.to_numpy(zero_copy_only=False).astype(np.int64)
            stride = max(idx.max(initial=0), gone.max(initial=0)) + 1
            stay = ~np.isin(rows * stride + idx, np.repeat(np.arange(n), lost) * stride + gone)
            has = one >= 0
            rows, idx, x = (np.concatenate(p) for p in ((rows[stay], np.arange(n)[has]), (idx[stay], one[has]), (x[stay], one_x[has])))
            order = _by_row_and_index(rows, idx)
            yield pa.RecordBatch.from_arrays([*map(get, kept), _as_feats(np.bincount(rows, minlength=n), idx[order], x[order])], [*kept, "feats"])

    return mapped(docs, merge, schema)


# A block of examples for the steps: a row is an example (an id and label), a slot an
# id. Binary columns are int64 (idx, starts, labels), int32 (rows, slots) and
# float64 (x): ``idx`` are the block's indices in order, ``starts`` where the
# features of each begin.
BLOCK_DDL = "block BIGINT, n BIGINT, far ARRAY<BIGINT>, labels BINARY, slots BINARY, idx BINARY, starts BINARY, rows BINARY, x BINARY"
NO_LABEL = -1 << 62


def _blocks(docs: DataFrame, limit: int, most: int) -> DataFrame:
    """The examples (id, label, feats) packed into blocks of about ``most``
    features; ``n`` counts the examples, repeated ones too. Examples of the same id
    share a block."""
    by_id = docs.groupBy("id").agg(F.collect_list(F.struct(F.coalesce(F.col("label").cast("bigint"), F.lit(NO_LABEL)).alias("label"), "feats")).alias("rows"))

    def pack(batches):
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def block():
            labels, slots, counts, idx, x = (np.concatenate(p) for p in zip(*held))
            slots = np.cumsum(slots) - 1  # given as 1 where a new id begins
            rows = np.repeat(np.arange(len(labels), dtype=np.int32), counts)
            order = np.argsort(idx, kind="stable")
            idx, rows, x = idx[order], rows[order], x[order]
            starts = _starts(idx)
            own = idx[starts]
            parts = (labels, slots.astype(np.int32), own, starts.astype(np.int64), rows, x)
            return pa.RecordBatch.from_arrays([
                pa.array([at], pa.int64()), pa.array([int((idx == BIAS).sum())], pa.int64()), pa.array([own[own >= limit]], pa.list_(pa.int64())),
                *[pa.array([p.tobytes()], pa.binary()) for p in parts]], ["block", "n", "far", "labels", "slots", "idx", "starts", "rows", "x"])

        for batch in batches:
            per, inner = lists(column(batch, "rows"))
            counts, idx, x = _feats(inner.field("feats"))
            labels = inner.field("label").to_numpy()
            new = np.zeros(len(labels), np.int64)
            new[np.cumsum(per) - per] = 1
            lo = 0
            ends, tops = np.cumsum(per), np.concatenate([[0], np.cumsum(counts)])
            while lo < len(labels):
                # whole ids up to the size of a block
                hi = max(int(np.searchsorted(tops, tops[lo] + most - size, side="right")) - 1, lo)
                hi = int(ends[np.searchsorted(ends, max(hi, lo + 1))])
                held.append((labels[lo:hi], new[lo:hi], counts[lo:hi], idx[tops[lo]:tops[hi]], x[tops[lo]:tops[hi]]))
                size += int(tops[hi] - tops[lo])
                lo = hi
                if size >= most:
                    yield block()
                    held, size, at = [], 0, at + 1
        if held:
            yield block()

    return mapped(by_id.select("rows"), pack, BLOCK_DDL)


def _step(blocks: DataFrame, head, names: list[str], limit: int) -> DataFrame:
    """idx and the gradient sums ``g<r>_<k>`` of the blocks; ``head``: a broadcast
    array of weights by name and index, the blocks' ``far_w`` (idx, weights) those
    beyond it."""
    out = [f"g{c[1:]}" for c in names]
    far_w = "far_w" in blocks.columns

    def rows_of(idx, sums):
        return pa.RecordBatch.from_arrays([pa.array(idx, pa.int64()), *[pa.array(s, pa.float64()) for s in sums]], ["idx", *out])

    def step(batches):
        near = head.value
        total, seen = np.zeros(near.shape), np.zeros(near.shape[1], bool)
        for batch in batches:
            for at in range(batch.num_rows):
                get = lambda c, kind: np.frombuffer(column(batch, c)[at].as_buffer(), kind)  # noqa: E731,B023
                labels, slots, idx, starts = get("labels", np.int64), get("slots", np.int32), get("idx", np.int64), get("starts", np.int64)
                rows, x = get("rows", np.int32), get("x", np.float64)
                cut = int(np.searchsorted(idx, limit))
                w = near[:, idx[:cut]]
                if cut < len(idx):
                    beyond = column(batch, "far_w")[at].values
                    order = np.argsort(beyond.field("idx").to_numpy())
                    w = np.concatenate([w, [beyond.field(c).to_numpy()[order] for c in names]], axis=1)
                counts, m = np.diff(np.append(starts, len(x))), int(slots[-1]) + 1
                ids = rows if m == len(labels) else slots[rows]
                z = np.stack([np.bincount(ids, weights=x * np.repeat(v, counts), minlength=m) for v in w])[:, slots].reshape(-1, CLASSES, len(labels))
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                e = (p - (labels == np.arange(CLASSES)[:, None])) * (labels != NO_LABEL)
                g = np.stack([np.add.reduceat(x * v[rows], starts) for v in e.reshape(-1, len(labels))])
                total[:, idx[:cut]] += g[:, :cut]
                seen[idx[:cut]] = True
                if cut < len(idx):
                    yield rows_of(idx[cut:], g[:, cut:])
        found = np.flatnonzero(seen)
        for lo in range(0, len(found), OUT_ROWS):
            part = found[lo:lo + OUT_ROWS]
            yield rows_of(part, total[:, part])

    kept = ["labels", "slots", "idx", "starts", "rows", "x", *(["far_w"] if far_w else [])]
    return mapped(blocks.select(kept), step, ", ".join(["idx BIGINT", *[f"{c} DOUBLE" for c in out]]))


def _own_indices(blocks: DataFrame, limit: int) -> DataFrame:
    """The indices of the blocks: those of the head once a task."""

    def own(batches):
        seen = np.zeros(limit, bool)
        for batch in batches:
            for v in batch.column(0):
                idx = np.frombuffer(v.as_buffer(), np.int64)
                seen[idx[idx < limit]] = True
                yield pa.RecordBatch.from_arrays([pa.array(idx[idx >= limit])], ["idx"])
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen))], ["idx"])

    return mapped(blocks.select("idx"), own, "idx BIGINT").distinct()


def _head_of(weights: DataFrame, names: list[str]):
    """The weights of the head, by name and index, for all tasks: a broadcast of
    bounded size."""
    found = weights.where(_near()).select("idx", *names).toArrow()
    idx = found.column("idx").to_numpy()
    head = np.zeros((len(names), int(idx.max(initial=BIAS)) + 1))
    for to, c in zip(head, names):
        to[idx] = found.column(c).to_numpy()
    return weights.sparkSession.sparkContext.broadcast(head)


def _limit() -> int:
    return V.FIRST_REAL_IDX + HEAD_ROWS


def _moved(state: DataFrame, penalties: tuple[float, ...], params: Params) -> DataFrame:
    """A step of weights beyond the head: idx, v<r>_<k>, w<r>_<k>."""
    new = ["idx"]
    for r, penalty in enumerate(penalties):
        for w, v, g in zip(_names("w", r), _names("v", r), _names("g", r)):
            step = F.col(v) * params.momentum - (F.col(g) + F.col(w) * penalty) * params.rate
            new += [step.alias(v), (F.col(w) + step).alias(w)]
    return state.select(*new)


def _fit(at: _Layout, penalties: tuple[float, ...], params: Params, only: Column | None = None) -> DataFrame:
    """idx, w<r>_<k>: the weights of every penalty r, learnt from all examples or
    those whose id is in ``only``. The head, of bounded size, is moved where it is
    broadcast from; weights beyond it lie in buckets."""
    docs = at.docs if only is None else at.docs.where(only)
    every = [c for r in range(len(penalties)) for kind in "wv" for c in _names(kind, r)]
    own = _names_of("w", penalties)
    kept, limit = len(at.tables), _limit()
    with at.partitions():
        blocks = at.bucketed(_blocks(docs, limit, BLOCK_ROWS), "block")
        n = blocks.agg(F.sum("n")).first()[0] or 0
        far = None if at.far is None else at.bucketed(blocks.select("block", F.explode("far").alias("idx")), "idx")
        found = _own_indices(blocks, limit)
        if far is not None:
            found = at.bucketed(found, "idx")
            state = at.bucketed(found.where(~_near()).select("idx", *[F.lit(0.0).alias(c) for c in every]), "idx")
        near = np.sort(found.where(_near()).toArrow().column("idx").to_numpy())
        w = np.zeros((len(own), int(near.max(initial=BIAS)) + 1))
        v, held = np.zeros_like(w), np.repeat(penalties, CLASSES)[:, None] * (np.arange(w.shape[1]) != BIAS)
        for _ in range(params.steps if n else 0):
            told, before = blocks, len(at.tables)
            if far is not None:
                rest = far.join(state.select("idx", *own), "idx").groupBy("block").agg(F.collect_list(F.struct("idx", *own)).alias("far_w"))
                told = blocks.join(rest.hint("shuffle_hash"), "block", "left")
            head = at.spark.sparkContext.broadcast(w)
            sums = _step(told, head, own, limit).groupBy("idx").agg(*[(F.sum(f"g{c[1:]}") / n).alias(f"g{c[1:]}") for c in own])
            if far is not None:
                sums = at.bucketed(sums, "idx")
                state = at.bucketed(_moved(state.join(sums, "idx"), penalties, params), "idx")
            found, g = sums.where(_near()).toArrow(), np.zeros_like(w)
            for to, c in zip(g, own):
                to[found.column("idx").to_numpy()] = found.column(f"g{c[1:]}").to_numpy()
            v = v * params.momentum - (g + w * held) * params.rate
            w = w + v
            head.destroy()
            if far is not None:
                at.drop_at(before - 1, before + 1)  # the state before this step, and its sums
        weights = at.spark.createDataFrame(pa.table([pa.array(near, pa.int64()), *[pa.array(c[near]) for c in w]], ["idx", *own]))
        if far is not None:
            weights = weights.unionByName(state.select("idx", *own))
        if at.alone is not None:
            one = at.alone.join(weights.withColumnRenamed("idx", "as_idx"), "as_idx").select("idx", *[(F.col("share") * F.col(c)).alias(c) for c in own])
            weights = weights.join(at.alone.select("idx"), "idx", "left_anti").unionByName(one)
        weights = stored(weights, "weights")
        at.drop(kept)
    return weights


def _scores(rows: DataFrame, weights: DataFrame, rs: tuple[int, ...] = (0,)) -> DataFrame:
    """id, z<r>_0, z<r>_1, ...: a row for every id that has features. Indices that
    were not trained on weigh nothing. Features beyond the head are written."""
    rows, limit = _gathered(rows, "id").select("id", "feats"), _limit()
    names = [c for r in rs for c in _names("w", r)]
    out = [f"z{c[1:]}" for c in names]
    far = weights.where(~_near()).select("idx", *names)
    beyond = not far.isEmpty()
    schema = StructType([rows.schema["id"], *StructType.fromDDL(", ".join([FEATS, *[f"{c} DOUBLE" for c in out]]))])
    head = _head_of(weights, names)

    def score(batches):
        near = head.value
        for batch in batches:
            sizes, idx, x = _feats(column(batch, "feats"))
            n = len(sizes)
            ids = np.repeat(np.arange(n), sizes)
            known, rest = idx < near.shape[1], idx >= limit
            z = [np.bincount(ids[known], weights=x[known] * w[idx[known]], minlength=n) for w in near]
            left = _as_feats(np.bincount(ids[rest], minlength=n), idx[rest], x[rest])
            yield pa.RecordBatch.from_arrays([column(batch, "id"), left, *[pa.array(v) for v in z]], ["id", "feats", *out])

    scored = mapped(rows, score, schema)
    if beyond:
        scored = stored(scored, "scores")
        terms = [(F.col("x") * F.col(c)).alias(z) for c, z in zip(names, out)]
        scored = scored.select("id", *out).unionByName(_apart(scored, "id").join(far, "idx").select("id", *terms))
    return scored.groupBy("id").agg(*[F.coalesce(F.sum(z), F.lit(0.0)).alias(z) for z in out])


def losses(rows: DataFrame, labels: DataFrame, weights: DataFrame, rs: tuple[int, ...] = (0,)) -> DataFrame:
    """id, label, loss<r>: cross-entropy of the predicted distribution."""
    found = _scores(rows, weights, rs).join(labels.select("id", "label"), "id")
    each = []
    for r in rs:
        p = _softmax([F.col(c) for c in _names("z", r)])
        own = F.coalesce(*[F.when(F.col("label") == k, x) for k, x in enumerate(p)])
        each.append((-F.log(F.greatest(own, F.lit(1e-300)))).alias(f"loss{r}"))
    return found.select("id", "label", *each)


def is_inner(id_col: str, seed: int) -> Column:
    return shuffle_key(id_col, seed) < F.lit(INNER_BELOW)


def choose(rows: DataFrame, labels: DataFrame, params: Params, at: _Layout | None = None) -> tuple[int, list[float]]:
    """Which penalty does best on the inner split, and the mean loss of each
    (the first of equals; the first penalty if the split is empty). ``at``: the
    layout of ``rows``, if there is one."""
    inner = is_inner("id", params.seed)
    laid = at or _Layout(rows)
    try:
        weights = _fit(laid, params.penalties, params, ~inner)
    finally:
        if at is None:
            laid.drop()
    rs = tuple(range(len(params.penalties)))
    found = list(losses(rows.where(inner), labels, weights, rs).agg(*[F.avg(f"loss{r}") for r in rs]).first())
    if found[0] is None:
        return 0, []
    return min(rs, key=lambda r: (round(found[r], 9), r)), found


def train(examples: DataFrame, vocab: DataFrame, params: Params = Params()) -> DataFrame:
    """The weights (idx, w0_<class>) learnt from ``examples`` (id, label, text)."""
    labels = examples.select("id", "label")
    rows = stored(_bags(V.encode(examples, vocab).select("id", "ids").join(labels, "id")), "features")
    at = _Layout(rows)
    try:
        best, _ = choose(rows, labels, params, at)
        return _fit(at, (params.penalties[best],), params)
    finally:
        at.drop()


def score(df: DataFrame, vocab: DataFrame, weights: DataFrame, id_col: str = "id", text: str = "text", out: str = "sentiment") -> DataFrame:
    """``df`` with the most likely class (the first of equals); −1 for a text
    without tokens. Ids are distinct."""
    encoded = stored(V.encode(df.select(F.col(id_col).alias("id"), F.col(text).alias("text")), vocab), "encoded")
    z = _scores(_bags(encoded.select("id", "ids")), weights)
    best = F.array(*[F.col(c) for c in _names("z", 0)])
    z = z.join(encoded.select("id", "n_tokens"), "id")
    cls = F.when(F.col("n_tokens") <= 0, F.lit(BAD_INPUT)).otherwise(F.array_position(best, F.array_max(best)) - 1).cast("int")
    return df.drop(out).join(z.select(F.col("id").alias(id_col), cls.alias(out)), id_col)


def evaluate(examples: DataFrame, vocab: DataFrame, weights: DataFrame) -> DataFrame:
    """label, n, log_loss of held-out examples (id, label, text)."""
    rows = _bags(stored(V.encode(examples, vocab), "encoded").select("id", "ids"))
    return losses(rows, examples, weights).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("loss0"), 4).alias("log_loss"))
