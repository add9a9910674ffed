"""Sliding event-time counts.

The reference keeps a 300 s window sliding by 1 s with an incremental reduce
and an inverse reduce. A native ``window(ts, '300 seconds', '1 second')`` copies
every row 300 times, so here everything starts from 1-second panes (a partial
aggregation that collapses hot keys before any shuffle) and the window is a
running sum of signed deltas: a pane enters with ``+c`` at its second and
leaves with ``-c`` (or, as one variant was written, ``+c``) ``width`` seconds
later. The output has one row per key and change point; the value at second
``t`` counts the window ``(t - width, t]``, i.e. the dense window whose
exclusive end is ``t + 1``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .indexing import prefix_sum

# The reference's window width and slide, in seconds.
WIDTH = 300
SLIDE = 1

INVERSES = ("subtract", "add")


def panes(df: DataFrame, key: str, sec: str = "sec", size: int = 1) -> DataFrame:
    """Count per key and ``size``-second pane (pane id = first second)."""
    start = (F.floor(F.col(sec) / size) * size).cast("bigint") if size != 1 else F.col(sec)
    return df.groupBy(F.col(key), start.alias(sec)).agg(F.count(F.lit(1)).alias("c"))


def sliding_count(df: DataFrame, key: str, sec: str = "sec", width: int = WIDTH,
                  inverse: str = "subtract", keep_zero: bool = True,
                  weight: str | None = None) -> DataFrame:
    """Change-point form of a sliding ``width``-second count per ``key``.

    ``inverse="subtract"`` is the invertible window; ``"add"`` reproduces an
    inverse written as ``x + y``, where value(t) = C(t) + C(t - width).
    ``keep_zero=False`` removes rows whose count fell to zero.
    ``weight`` takes pre-aggregated pane counts instead of one row per event.
    """
    if inverse not in INVERSES:
        raise ValueError(f"inverse must be one of {INVERSES}")
    p = (df.select(F.col(key), F.col(sec), F.col(weight).alias("c")) if weight
         else panes(df, key, sec))
    sign = -1 if inverse == "subtract" else 1
    # both deltas of a pane come from one row (a generator, not a self-union,
    # so the pane aggregation is computed once)
    both = F.explode(F.array(
        F.struct(F.col(sec).alias("s"), F.col("c").alias("d")),
        F.struct((F.col(sec) + F.lit(width)).alias("s"), (F.col("c") * F.lit(sign)).alias("d")),
    ))
    deltas = p.select(key, both.alias("_e")).select(key, F.col("_e.s").alias(sec), F.col("_e.d").alias("d"))
    out = prefix_sum(deltas, [key], sec, "d", "n", last_per_order=True).select(key, sec, "n")
    return out if keep_zero else out.filter(F.col("n") != 0)


def window_ends(pane_start: Column, pane: int, width: int, slide: int) -> Column:
    """Exclusive ends of all ``width``/``slide`` windows (aligned to the epoch)
    that contain the ``pane``-second pane starting at ``pane_start``."""
    k_hi = F.floor(pane_start / slide)
    k_lo = F.ceil((pane_start + F.lit(pane) - F.lit(width)) / slide)
    return F.sequence((k_lo * slide + width).cast("bigint"), (k_hi * slide + width).cast("bigint"),
                      F.lit(slide).cast("bigint"))


def dense_sliding_count(df: DataFrame, key: str, width: int, slide: int,
                        sec: str = "sec") -> DataFrame:
    """One row per (key, window_end) with a non-zero count over windows
    ``[end - width, end)`` that start every ``slide`` seconds.

    Events are first counted per pane of gcd(width, slide) seconds; each pane
    then feeds only the width/slide windows that contain it.
    """
    from math import gcd

    g = gcd(width, slide)
    p = panes(df, key, sec, size=g)
    ends = p.select(key, F.explode(window_ends(F.col(sec), g, width, slide)).alias("window_end"), "c")
    return ends.groupBy(key, "window_end").agg(F.sum("c").cast("bigint").alias("n"))


def top_per_window(dense: DataFrame, key: str, k: int = 10) -> DataFrame:
    """Ten (k) largest counts per window, ties broken by key; Spark plans the
    ``rank <= k`` filter as a per-partition group limit before the shuffle."""
    w = Window.partitionBy("window_end").orderBy(F.desc("n"), F.asc(key))
    return (dense.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select("window_end", F.col("rank").cast("int").alias("rank"), key, "n"))


def top_as_of(df: DataFrame, key: str, width: int, k: int = 10, sec: str = "sec",
              at: Column | None = None) -> DataFrame:
    """Top ``k`` keys by count in ``(at - width, at]``; ``at`` defaults to the
    latest second in ``df``. The rows are read once: then they are counted by
    pane, and the panes, written, give the latest second and the counts."""
    counted = stored(panes(df, key, sec), "panes") if at is None else panes(df, key, sec)
    t = at if at is not None else counted.select(F.max(sec)).scalar()
    inside = counted.filter((F.col(sec) > t - F.lit(width)) & (F.col(sec) <= t))
    counts = inside.groupBy(key).agg(F.sum("c").cast("bigint").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(key)).limit(k)
