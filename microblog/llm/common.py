"""Helpers shared by the training-data operators.

Tasks receive Arrow record batches (``mapInArrow``) and cut them into blocks of
bounded text size, so that a task's memory does not depend on how many rows or
how long texts a partition has.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ensure_checkpoint_dir, scratch_path

BLOCK_BYTES = 8 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """What every query needs: the shared folder, and workers that find this
    package where it lies (on a cluster it is installed or sent as a py-file).
    Tasks get their rows in batches of a block's size, which executor and worker
    both hold; a session that has a size of its own keeps it."""
    ensure_checkpoint_dir(spark)
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, str(BLOCK_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: lineage
    is cut and the rows survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Shuffle files of finished jobs go once the driver's JVM has collected what
    refers to them. Between many rounds of small jobs it would not do so by
    itself, and the files of all rounds would lie on the disks together. It gives
    back the memory, too, that those jobs took on the driver."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5 (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def blocks(batches: Iterable[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of ``text`` each, or
    one row if that alone is longer. Whole rows only, none left out. At the end
    Arrow gives back what it keeps for later: workers outlive their tasks."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        size = np.asarray(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.cumsum(size)
        start = 0
        while start < n:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()


def spread(work: DataFrame, *keys: str) -> DataFrame:
    """Small rows that stand for much work, dealt to the session's number of
    shuffle partitions; a number given is one that Spark does not lower."""
    return work.repartition(int(work.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a block; null reads as the empty text."""
    return [t or "" for t in column(batch, name).to_pylist()]


def spread64(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a uint64 over all others."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))
