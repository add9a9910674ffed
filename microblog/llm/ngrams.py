"""Language-model scores by a weighted backoff automaton.

States are the root and every context, a sequence of up to ``order`` - 1 tokens
that the training texts hold at least ``STATE`` times. A state h has an arc for
every token w that follows it there, with weight
log10((c(hw) + mu P(w | h')) / (c(h) + mu)), and a failure arc with weight
log10(mu / (c(h) + mu)) to the state h' of the longest shorter context; P(w | h')
is what h' gives w, and the root reads w with weight log10 p(w),
p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)). So every state's weights are those of
a whole distribution (Dirichlet smoothing). Reading a text from left to right, a
state without an arc for the token takes its failure arc and tries again; the
arc it finds leads to the state of the longest context that has been read. The
weights on the way add up to the text's log10 probability.

The automaton grows with the corpus, so it is never in one place. Texts are cut
into blocks, written in buckets of the block number. One round per order: a
block asks for the counts of its distinct n-grams whose context is a state (for
the first round: of its words); the shards that own them (by range of the hash)
add up what all blocks contribute and answer each block in the order of its
question. In the last round a block has all counts of its part of the automaton
and is traversed: contexts are nested, so the state before a token is the
deepest order whose context is one, and failure arcs lead one order down; numpy
walks all tokens of a block side by side, an order at a time.

A frequent n-gram is one entry per block, and ranges of hashes are even, so no
n-gram is hot. Shards are so many that one adds up about ``SHARD_GRAMS`` entries,
and blocks ask only shards whose n-grams they have.

Tokens: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, then one end, which is
counted as a token; a text begins in the state of the end. Null and empty texts
are an end alone; rows with a null id are scored, not learnt from; repeated rows
count as often as they stand there; other columns are not read. N-grams are
known by 64-bit hashes: two of a billion share one with probability 3e-2, one
count of such a pair would then be too large.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import blocks, column, materialise, spread64, texts_of

ORDER = 3
MU = (60.0, 5.0, 2.0)  # of orders 2, 3 and all above
STATE = 2
SHARD_GRAMS = 2_000_000
_END = b"\n"  # no word holds a line end
_BLOCK = 8 << 20


class _Numbers(dict):
    """Words to numbers, in the order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _planes(x: np.ndarray) -> bytes:
    """The array's first bytes, then its second ones and so on: what compresses."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def _array(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()


def cut(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """A row per block of texts: its number, ids, whether to learn from each,
    token counts, the block's words and every token's number among them. Written
    once, as a table of the session's catalog in buckets of the block number,
    whose name comes second; its files lie in the shared folder."""
    spark = docs.sparkSession
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("learn", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int64())), ("words", pa.binary()), ("tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, text, _BLOCK):
            numbers = _Numbers()
            numbers[_END]
            get, parts = numbers.__getitem__, []
            for t in texts_of(b, text):
                words = t.encode().lower().split()
                words.append(_END)
                parts.append(np.fromiter(map(get, words), dtype=np.uint32, count=len(words)))
            tokens = np.concatenate(parts)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((
                column(b, key).cast(pa.int64()).to_pylist(), column(b, "learn").to_pylist(), [len(p) for p in parts],
                zlib.compress(b" ".join(numbers), 1), zlib.compress(_planes(tokens), 1)), schema.types)], schema=schema)

    rows = docs.select(F.col(key), F.col(text), learn.alias("learn")).mapInArrow(
        run, "ids array<bigint>, learn array<boolean>, sizes array<bigint>, words binary, tokens binary")
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"text_blocks_{uuid.uuid4().hex}"
    rows = rows.withColumn("block", F.monotonically_increasing_id()).repartition(n, "block")
    rows.write.bucketBy(n, "block").sortBy("block").format("parquet").option("path", scratch_path(spark, "text-blocks")).saveAsTable(name)
    return spark.table(name), name


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


class _Block:
    """A block's tokens and, order by order, its distinct n-grams ``keys``
    (ascending), where each token's is ``at`` (-1: its context is no state) and
    the corpus counts of n-gram and context ``count`` and ``context``."""

    def __init__(self, row: dict):
        words = zlib.decompress(row["words"]).split(b" ")
        tokens = _array(zlib.decompress(row["tokens"]), np.uint32)
        self.sizes = np.asarray(row["sizes"], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.learn = np.repeat(np.asarray(row["learn"], dtype=bool), self.sizes)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
        self.word, self._end = hashes[tokens], hashes[0]  # number 0 is the end
        self.gram = self.word
        self.keys, self.at = np.unique(self.word, return_inverse=True)
        self.end_at = int(np.searchsorted(self.keys, self._end))
        self.order = 1

    def answered(self, counts: np.ndarray, last: bool = False) -> None:
        """The counts of the last keys; on to the next order, if there is one."""
        own = np.where(self.at >= 0, counts[self.at], 0) if len(counts) else np.zeros(len(self.at), counts.dtype)
        self.count = own
        if last:  # nothing but the counts is read any more
            del self.word, self.gram, self.keys, self.at
            return
        self.context, gram = np.empty_like(own), np.empty_like(self.gram)
        self.context[1:], gram[1:] = own[:-1], self.gram[:-1]
        first = self.order == 1  # a text begins after an end; longer contexts begin inside it
        self.context[self.starts] = counts[self.end_at] if first else 0
        gram[self.starts] = self._end
        self.order += 1
        self.gram = spread64(gram * np.uint64(0x9E3779B97F4A7C15) + spread64(self.word))
        known = np.flatnonzero(self.context >= STATE)
        self.keys, at = np.unique(self.gram[known], return_inverse=True)
        self.at = np.full(len(self.word), -1, np.int64)
        self.at[known] = at


def _read(row: dict, answers: pd.DataFrame, last: int | None = None) -> tuple[_Block, list[tuple[np.ndarray, np.ndarray]]]:
    """The block after all rounds so far, and (given the ``last`` one, up to
    which they go, to be traversed) count and context per round."""
    b, seen = _Block(row), []
    context = np.zeros(len(b.word), np.float64)
    for level, own in answers.sort_values(["level", "shard"]).groupby("level"):
        counts = np.concatenate([_array(x, np.uint64) for x in own["counts"]])
        b.answered(counts, level == last)
        if last is not None:
            seen.append((b.count.astype(np.float64), context))
            context = b.context.astype(np.float64) if level < last else context
    return b, seen


def _asks(b: _Block, number: int, shards: int) -> dict:
    """A row per shard that owns some of the block's n-grams; ascending hashes
    as differences, which need fewer bytes."""
    counts = np.bincount(b.at[b.learn & (b.at >= 0)], minlength=len(b.keys)).astype(np.uint32)
    own = _shard(b.keys, shards)
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    ends = [*starts[1:].tolist(), len(own)]
    cuts = list(zip(starts.tolist(), ends))
    return {"shard": own[starts], "block": [number] * len(cuts), "keys": [_planes(np.diff(b.keys[s:e], prepend=np.uint64(0))) for s, e in cuts], "counts": [_planes(counts[s:e]) for s, e in cuts]}


_ASK = "shard bigint, block bigint, keys binary, counts binary"


def _summed(asked: DataFrame, level: int) -> DataFrame:
    """(block, level, shard, counts, known, n): the corpus counts, in the order
    of each block's question; ``known`` and ``n`` are the shard's distinct
    n-grams and tokens, on one of its rows. Written once."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(_array(x, np.uint64), dtype=np.uint64) for x in rows["keys"]]
        counts = np.concatenate([_array(x, np.uint32) for x in rows["counts"]])
        _, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, weights=counts).astype(np.uint64)
        pa.default_memory_pool().release_unused()
        ends = np.cumsum([len(k) for k in keys])
        first = np.arange(len(rows)) == 0
        return pd.DataFrame({"block": rows["block"], "level": level, "shard": rows["shard"], "counts": [_planes(total[which[e - len(k):e]]) for k, e in zip(keys, ends)],
                             "known": np.where(first, int((total > 0).sum()), 0), "n": np.where(first, int(total.sum()), 0)})

    return materialise(asked.groupBy("shard").applyInPandas(add, "block bigint, level int, shard bigint, counts binary, known bigint, n bigint"), "ngram-counts")


def score(docs: DataFrame, learn: Column, order: int = ORDER, mu: tuple[float, ...] = MU, shards: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every text;
    ``learn`` marks the rows that the model is made of. ``mu`` smooths orders 2,
    3, ...; the last one holds for all above. ``shards`` follows the number of
    tokens unless given."""
    texts, name = cut(docs, F.coalesce(learn, F.lit(False)), key, text)
    spark = docs.sparkSession
    if shards is None:
        tokens = texts.agg(F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)"))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // SHARD_GRAMS))
    parts = ["block", "learn", "sizes", "words", "tokens"]

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                out = _asks(_Block(row), row["block"], shards)
                yield pa.RecordBatch.from_arrays([pa.array(out["shard"], pa.int64()), pa.array(out["block"], pa.int64()), pa.array(out["keys"], pa.binary()), pa.array(out["counts"], pa.binary())],
                                                 names=["shard", "block", "keys", "counts"])

    def longer(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0]
        b, _ = _read(row, answers)
        pa.default_memory_pool().release_unused()
        return pd.DataFrame(_asks(b, int(row["block"]), shards))

    counted = _summed(texts.select(*parts).mapInArrow(words, _ASK), 1)
    known, n = (int(x or 0) for x in counted.agg(F.sum("known"), F.sum("n")).first())
    answers = counted.select("block", "level", "shard", "counts")
    for level in range(2, order + 1):
        asked = texts.select(*parts).groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(longer, _ASK)
        answers = answers.unionByName(_summed(asked, level).select(answers.columns))

    def traverse(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0]
        b, seen = _read(row, answers, order)
        pa.default_memory_pool().release_unused()
        root = np.log10((seen[0][0] + 0.5) / (n + 0.5 * (known + 1)))
        state = np.ones(len(root), np.int64)  # the order of the arcs of the state before each token
        arcs, fails, below = [None, root], [None, None], root
        for level, (count, context) in enumerate(seen[1:], 2):
            m = mu[min(level - 2, len(mu) - 1)]
            state[context >= STATE] = level
            with np.errstate(divide="ignore"):  # no context, no state: not used
                arcs.append(np.log10((count + m * 10.0 ** below) / (context + m)))
                fails.append(np.log10(m / (context + m)))
            below = np.where(context >= STATE, np.where(count > 0, arcs[-1], fails[-1] + below), below)
        weight = np.zeros(len(root))
        for level in range(len(seen), 1, -1):
            here = state == level
            found = here & (seen[level - 1][0] > 0)
            weight[found] += arcs[level][found]
            weight[here & ~found] += fails[level][here & ~found]
            state[found] = 0  # read
            state[here & ~found] = level - 1  # the failure arc
        weight[state == 1] += root[state == 1]
        total = lambda x: np.add.reduceat(x, b.starts)
        return pd.DataFrame({key: pd.array(row["ids"], dtype="Int64"), "n_tokens": b.sizes, "n_known": total((seen[0][0] > 0).astype(np.int64)),
                             "train_tokens": n, "base_score": total(root), "score": total(weight)})

    ddl = f"`{key}` bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    out = materialise(texts.select("ids", *parts).groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(traverse, ddl), "text-scores")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out
