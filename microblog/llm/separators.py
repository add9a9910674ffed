"""Token counts by separator scan.

A corpus of flat token files (unsigned 16- or 32-bit ids, little-endian, no
index) is cut into blocks at fixed byte offsets, each block is read by a task
on its own and searched for the end-of-document id in one vectorised
comparison. A block only knows the ends inside it. A prefix scan over the block
summaries (how many ends, where the last one is) gives each block the number
of documents before it and the start of the one that runs into it, however
many blocks that covers; the lists of ends never meet in one task.

Definitions: a document is the ids up to and with its separator, and counts
the ids before it (so two adjacent separators enclose a document of 0 tokens);
ids after a file's last separator form a last, unended document
(``ended`` false); a file without ids has none. In ``write_tokens`` a null text
is the empty text; null and repeated ids are kept in the manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import blocks, column, materialise, spread, texts_of
from .files import new_file, open_store
from .tokens import encoder, read_tokenizer

BLOCK_IDS = 1 << 20
FILE_BYTES = 256 << 20


def write_tokens(docs: DataFrame, tokenizer_path: str, pattern: str, separator: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the documents as flat token files below the shared folder; returns
    the manifest (file, bytes, ordinal, key), itself written there. A task
    starts another file once one holds ``FILE_BYTES``."""
    spark = docs.sparkSession
    data = spark.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    folder = scratch_path(spark, "tokens")
    schema = pa.schema([("file", pa.string()), ("bytes", pa.int64()), ("ordinal", pa.int64()), (key, pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(data.value, pattern)
        end = np.array([separator], dtype="<u2").tobytes()
        cut = blocks(batches, text)
        b = next(cut, None)
        while b is not None:
            name = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.u16"
            size, keys = 0, []
            with new_file(name) as f:
                while b is not None and size < FILE_BYTES:
                    for raw in encode(texts_of(b, text)):
                        ids = np.frombuffer(raw, dtype="<u4")
                        if len(ids) and int(ids.max()) > 0xFFFF:
                            raise ValueError("an id does not fit 16 bits")
                        out = ids.astype("<u2").tobytes() + end
                        f.write(out)
                        size += len(out)
                    keys.append(column(b, key).cast(pa.int64()))
                    b = next(cut, None)
            ids = pa.concat_arrays(keys)
            n = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array([size] * n, pa.int64()), pa.array(range(n), pa.int64()), ids], schema=schema)

    return materialise(docs.select(key, text).mapInArrow(run, f"file string, bytes bigint, ordinal bigint, `{key}` bigint"), "manifest")


def scan(files: DataFrame, separator: int, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) per document of the flat token
    files in ``files`` (file, bytes; repeated rows count once, null files are
    left out). ``start`` counts ids."""
    if width not in (2, 4):
        raise ValueError("ids are 2 or 4 bytes wide")
    step = width * block_ids
    todo = (files.where("file is not null and bytes > 0").select("file", "bytes").distinct()
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(bytes - 1) div {step}")))))
    todo = spread(todo, "file", "block")
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("last", pa.int64()), ("size", pa.int64()), ("final", pa.bool_()), ("ends", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, name = open_store(row["file"])
                at = row["block"] * step
                with store.open_input_file(name) as f:
                    raw = f.read_at(min(step, row["bytes"] - at), at)
                ids = np.frombuffer(raw, dtype=f"<u{width}")
                ends = np.flatnonzero(ids == separator) + at // width
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
                    (row["file"], row["block"], len(ends), int(ends[-1]) if len(ends) else None, at // width + len(ids), at + step >= row["bytes"], ends), schema.types)], schema=schema)

    found = materialise(todo.select("file", "bytes", "block").mapInArrow(
        run, "file string, block bigint, n bigint, last bigint, size bigint, final boolean, ends array<bigint>"), "separators")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = found.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skipped"),
                           F.coalesce(F.max("last").over(before) + 1, F.lit(0)).alias("open"))
    # the last block of a file closes what no separator ended
    ends = F.when(F.col("final") & (F.coalesce(F.col("last") + 1, F.col("open")) < F.col("size")), F.concat("ends", F.array("size"))).otherwise(F.col("ends"))
    both = found.join(carried, ["file", "block"]).withColumn("ends", ends)
    at = both.select("file", "skipped", "open", "n", "ends", F.posexplode("ends").alias("i", "stop"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.element_at("ends", F.greatest(F.col("i"), F.lit(1))) + 1)
    return at.select("file", (F.col("skipped") + F.col("i")).alias("ordinal"), start.alias("start"),
                     (F.col("stop") - start).alias("n_tokens"), (F.col("i") < F.col("n")).alias("ended"))


def document_counts(docs: DataFrame, tokenizer_path: str, pattern: str, separator: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, file_ordinal, start): the documents written as flat token
    files and counted by scanning those."""
    manifest = write_tokens(docs, tokenizer_path, pattern, separator, key, text)
    found = scan(manifest, separator)
    return manifest.join(found, ["file", "ordinal"]).select(key, "n_tokens", F.col("ordinal").alias("file_ordinal"), "start")
