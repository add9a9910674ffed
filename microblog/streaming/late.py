"""Late rows kept instead of dropped, and corrections for finished windows.

``split_writer`` deals the rows of every micro-batch to two tables before any
window sees them: on time, and late, that is with a pane that ended before the
watermark (the newest event time of the batches before, less the delay, the rule
by which Spark's own stateful operators drop rows). Windows are then computed on
a stream of the first table, with the same delay, where nothing is late any
more; ``corrections`` turns the second into signed records for the same windows.
Emitted counts plus corrections equal the batch count over all rows.

Both tables are ``batch_id=N`` folders written with overwrite, and every batch
records its horizon in one more: a replayed batch finds the same horizon and
rewrites the same rows, and a batch whose predecessor's horizon is gone fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import windows
from ..sinks import folders
from ..sinks.keyed import upsert_batch


def _ms(col: str):
    return F.unix_millis(F.col(col))


def horizon_before(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """The newest event time (ms) of the batches before this one."""
    if batch_id == 0:
        return None
    if not folders.complete(spark, f"{root}/horizon/batch_id={batch_id - 1}"):
        raise RuntimeError(f"the horizon of batch {batch_id - 1} is missing in {root}")
    return spark.read.schema("newest bigint").parquet(f"{root}/horizon/batch_id={batch_id - 1}").first().newest


def split_writer(root: str, delay_ms: int, pane_seconds: int = 1, time_col: str = "created_at"):
    """foreachBatch body: ``root/on_time`` and ``root/late`` (plus ``horizon``).
    Rows without an event time are late: no window can hold them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = horizon_before(spark, root, batch_id)
        batch = batch.persist()  # three tables from one read
        try:
            pane_end = (F.floor(_ms(time_col) / (1000 * pane_seconds)) + 1) * 1000 * pane_seconds
            late = F.col(time_col).isNull() if newest is None else F.col(time_col).isNull() | (pane_end <= newest - delay_ms)
            upsert_batch(batch.where(late), f"{root}/late", batch_id)
            upsert_batch(batch.where(~late), f"{root}/on_time", batch_id)
            seen = batch.agg(F.max(_ms(time_col)).alias("newest"))
            upsert_batch(seen.select(F.greatest("newest", F.lit(newest).cast("bigint")).alias("newest")), f"{root}/horizon", batch_id)
        finally:
            batch.unpersist()

    return write


def on_time(spark: SparkSession, root: str, schema) -> DataFrame:
    """The rows that were on time, as a stream."""
    return spark.readStream.schema(schema).parquet(f"{root}/on_time/batch_id=*")


def late_rows(spark: SparkSession, root: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/late/batch_id=*")


def corrections(rows: DataFrame, key: str, width: int, slide: int, sec: str = "sec") -> DataFrame:
    """key, window_end, n: what the windows of ``dense_sliding_count`` lack
    without these rows. Rows without a time change no window."""
    return windows.dense_sliding_count(rows.where(F.col(sec).isNotNull()), key, width, slide, sec)


def corrected(emitted: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Emitted window counts with their corrections added: a window may have
    either or both."""
    both = emitted.select(key, "window_end", "n").unionByName(changes.select(key, "window_end", "n"))
    return both.groupBy(key, "window_end").agg(F.sum("n").cast("bigint").alias("n"))
