"""A stated query set against all rows, in blocks.

Vectors of one length meet each other; lengths are sets of their own.
Candidates and queries are dealt to groups of a stated number of bytes by a hash
of their row number, which no vector, id or copy can make uneven. Each pair of
groups is one task's work (a cogroup): it takes ``QUERIES`` queries at a time,
returns the best ``k`` of the group for each of them, and a window per query
picks the best of those. A candidate is copied once for each group of queries, a
query once for each group of candidates; there are more groups of candidates
than their bytes ask for, of ``LEAST_ROWS`` rows and more, where the pairs would
be fewer than the session's shuffle partitions. No task holds more than two groups; nothing is broadcast.

Vectors that are null or empty, hold null, NaN or infinite components, or have a
null id take no part. Rows that repeat are rows of their own: a query's twin is
a candidate, only the query's own row is not. A query without a candidate of its
length has no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

GROUP_BYTES = 16 << 20  # of a group's vectors in double precision
QUERIES = 2_048
LEAST_ROWS = 4_096


def usable(df: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """(row, id, vec): the rows that take part, written once."""
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & fine & (F.size(vector) > 0))
    if not zero:
        rows = rows.where(F.exists(F.col(vector), lambda x: x != 0))
    return materialise(rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("bigint").alias("id"),
                                   F.col(vector).cast("array<double>").alias("vec")), "vectors")


def distinct_vectors(rows: np.ndarray, ids: np.ndarray, vecs: np.ndarray, k: int):
    """Distinct vectors and, for each, the rows that hold it, by id; no more
    than k + 1 of them, as no query returns more (one may be its own)."""
    order = np.lexsort((rows, ids))
    rows, ids, vecs = rows[order], ids[order], np.ascontiguousarray(vecs[order])
    _, first, which = np.unique(vecs.view(np.dtype((np.void, vecs.dtype.itemsize * vecs.shape[1]))).ravel(), return_index=True, return_inverse=True)
    by = np.argsort(which, kind="stable")
    starts = np.searchsorted(which[by], np.arange(len(first)))
    holders = [by[s:e][:k + 1] for s, e in zip(starts, [*starts[1:], len(by)])]
    return vecs[first], [(ids[h].tolist(), rows[h].tolist()) for h in holders]


def nearest(df: DataFrame, divisor: int, k: int, best: Callable, score: str, key: str, vector: str,
            zero: bool, group_bytes: int = GROUP_BYTES, queries: int = QUERIES, least_pairs: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each usable row whose id is
    divisible by ``divisor``, the ``k`` candidates of the highest score, ties to
    the smaller id. ``best(q, q_rows, vecs, holders, k)`` yields (query index,
    candidate id, score) for one pair of groups."""
    rows = usable(df, key, vector, zero).withColumn("dim", F.size("vec"))
    least = least_pairs or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fits = F.greatest(F.lit(1), F.floor(F.lit(group_bytes) / (F.col("dim") * 8)))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())  # a row per length
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(F.col("id") % divisor == 0).alias("m"))
    sizes = sizes.withColumn("share", share).where("m > 0").withColumn("q_groups", F.ceil(F.col("m") / fits))
    sizes = sizes.select("dim", "q_groups", F.greatest(F.ceil(F.col("n") / fits), F.least(F.ceil(F.col("n") / LEAST_ROWS), F.ceil(F.col("share") * least / F.col("q_groups")))).alias("c_groups"))
    own = rows.join(materialise(sizes, "sizes"), "dim")
    deal = lambda m, seed: F.expr(f"cast(pmod(xxhash64(row, {seed}), {m}) as int)")
    every = lambda m: F.explode(F.expr(f"sequence(0, cast({m} as int) - 1)"))
    right = own.withColumn("c", deal("c_groups", 1)).withColumn("q", every("q_groups")).select("dim", "q", "c", "row", "id", "vec")
    left = own.where(F.col("id") % divisor == 0).withColumn("q", deal("q_groups", 2)).withColumn("c", every("c_groups")).select(*(F.col(c).alias(c) for c in ("dim", "q", "c", "row", "id", "vec")))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_row": [], "query_id": [], "vec_id": [], "score": []})
        vecs, holders = distinct_vectors(b["row"].to_numpy(), b["id"].to_numpy(), np.stack(b["vec"].to_numpy()), k)
        q_rows, q_ids, found = a["row"].to_numpy(), a["id"].to_numpy(), []
        for i in range(0, len(a), queries):
            part = a["vec"].iloc[i:i + queries].to_numpy()
            found += [(i + x, j, s) for x, j, s in best(np.stack(part), q_rows[i:i + queries], vecs, holders, k)]
        at = np.array([x[0] for x in found], dtype=np.int64)
        return pd.DataFrame({"query_row": q_rows[at], "query_id": q_ids[at], "vec_id": [x[1] for x in found], "score": [x[2] for x in found]})

    by = ("dim", "q", "c")
    met = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(meet, f"query_row bigint, query_id bigint, vec_id bigint, score {score}")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(f"rank <= {int(k)}").select("query_id", "rank", "vec_id", "score")
