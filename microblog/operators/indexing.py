"""Ordered computations that must not funnel a key, or the whole table, into
one task.

``prefix_sum``
    Running sum per key along an integral order column. Rows are cut into
    fixed-width blocks of the order column; each (key, block) runs its own
    window in parallel, and the per-block totals — one row per key and block,
    bounded by the time span / block width rather than by the row count —
    give each block its starting offset. A key holding a third of all rows is
    therefore spread over as many tasks as it has blocks.

``global_rank``
    Dense 1-based position in a total order over the whole frame. The frame is
    range-partitioned on the order, sorted inside each partition and written
    once as a table in the checkpoint folder; each partition's row count (one
    row per partition) yields its offset. No window without a partition key is ever
    evaluated over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import scratch_path

DEFAULT_BLOCK = 86_400  # one day of seconds


def prefix_sum(df: DataFrame, keys: list[str], order: str, value: str | list[str],
               out: str | list[str], block: int = DEFAULT_BLOCK,
               last_per_order: bool = False) -> DataFrame:
    """Add ``out`` = sum of ``value`` over rows of the same ``keys`` with
    ``order`` <= this row's ``order`` (ties summed together). ``value`` and
    ``out`` may be parallel lists to carry several running sums in one pass.

    Rows without an ``order`` have no place and are left out; null keys count as
    one key.

    With ``last_per_order`` only one row per (keys, order) is kept, so several
    delta rows at the same position collapse into one output row without an
    extra shuffle.
    """
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    blk = "_blk"
    d = df.where(F.col(order).isNotNull()).withColumn(blk, F.floor(F.col(order) / F.lit(block)).cast("bigint"))
    part = [*keys, blk]
    w = Window.partitionBy(*part).orderBy(order)
    frame = w.rangeBetween(Window.unboundedPreceding, 0)
    local = d
    for i, v in enumerate(values):
        local = local.withColumn(f"_local{i}", F.sum(v).over(frame))
    if last_per_order:
        local = local.withColumn("_next", F.lead(order).over(w)).filter(
            F.col("_next").isNull() | (F.col("_next") != F.col(order))
        ).drop("_next")
    totals = d.groupBy(*part).agg(*[F.sum(v).alias(f"_tot{i}") for i, v in enumerate(values)])
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy()
    wb = wk.orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, *[
        F.coalesce(F.sum(f"_tot{i}").over(wb), F.lit(0)).alias(f"_off{i}") for i in range(len(values))
    ])
    a, b = local.alias("a"), offsets.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in part]  # a null key is a key
    on = same[0]
    for c in same[1:]:
        on = on & c
    res = a.join(b, on).select("a.*", *[f"b._off{i}" for i in range(len(values))])
    for i, o in enumerate(outs):
        res = res.withColumn(o, (F.col(f"_local{i}") + F.col(f"_off{i}")).cast("bigint"))
    return res.drop(blk, *[f"_local{i}" for i in range(len(values))], *[f"_off{i}" for i in range(len(values))])


def global_rank(df: DataFrame, order: list[Column], out: str = "rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out``: 1-based row position under ``order`` (must be a total order)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order)
              .sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    # Range bounds are sampled per exchange: the rows and the per-partition
    # counts must come from one materialisation, so it is written once as a
    # table in the shared checkpoint folder (one job; survives executor loss).
    path = scratch_path(spark, "global-rank")
    ranged.write.parquet(path)
    ranged = spark.read.parquet(path)
    # monotonically_increasing_id = (partition << 33) + position in partition
    local = ranged.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offs = counts.select(
        "_pid",
        F.coalesce(F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
    )
    # one row per partition: a size bound known before the job runs
    return (local.join(F.broadcast(offs), "_pid")
            .withColumn(out, F.col("_off") + F.col("_pos") + F.lit(1))
            .drop("_pid", "_mid", "_pos", "_off"))
