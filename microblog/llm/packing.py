"""Packing by power-of-two decomposition.

A document's ids (with the separator id at its end) are cut into pieces of
binary lengths: full sequences of ``length`` ids, then one piece per set bit of
the rest, longest first. Every piece is a sequence of its own, so no sequence
crosses documents, none needs padding, and sequences of equal length share a
bucket (``bucket`` = log2 of the length).

Definitions: a null text is the empty text, so its document is the separator
alone (one piece of length 1); rows with null or repeated ids are packed like
any other; the tokenizer's added tokens have their ids wherever they stand; the
input's other columns are not read. ``sequence_id`` numbers the
pieces in the order of the scan (partition number, then position): unique, and
the same again when a lost task reruns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, blocks, column, texts_of
from .tokens import encoder, read_tokenizer

LENGTH = 1024


def piece_lengths(n: int, length: int = LENGTH) -> list[int]:
    """Binary lengths that sum up to n: as many of ``length`` as fit, then
    falling powers of two. ``length`` is a power of two."""
    rest = n % length
    return [length] * (n // length) + [1 << b for b in range(length.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, length: int = LENGTH, separator: int = 0,
         key: str = "doc_id", text: str = "text", with_ids: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row per piece: key, start, length, doc_tokens, ids_crc32, bucket,
    sequence_id, offset and, unless ``with_ids`` is off, the ids. ``block_bytes``
    of text are encoded at once: fewer take less memory and more time."""
    if length < 1 or length & (length - 1):
        raise ValueError("the sequence length must be a power of two")
    data = docs.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    end = int(separator).to_bytes(4, "little")
    fields = [(key, pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.list_(pa.int32()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(data.value, pattern, added=True)
        for b in blocks(batches, text, block_bytes):
            raw = [x + end for x in encode(texts_of(b, text))]
            totals = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) // 4
            sizes = [piece_lengths(n, length) for n in totals.tolist()]
            row = np.repeat(np.arange(len(raw)), [len(x) for x in sizes])
            lengths = np.fromiter(chain.from_iterable(sizes), dtype=np.int64, count=len(row))
            ends = np.cumsum(lengths)
            starts = ends - lengths
            joined = memoryview(b"".join(raw))
            crcs = [zlib.crc32(joined[i:j]) for i, j in zip((starts * 4).tolist(), (ends * 4).tolist())]
            own = starts - (np.cumsum(totals) - totals)[row]
            arrays = [column(b, key).cast(pa.int64()).take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (own, lengths, totals[row], crcs))]
            if with_ids:
                arrays.append(pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1:]), pa.int32()), pa.array(np.frombuffer(joined, dtype="<i4"))))
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    ddl = f"`{key}` bigint, start bigint, length bigint, doc_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return (docs.select(key, text).mapInArrow(run, ddl)
            .withColumn("bucket", F.log2("length").cast("int"))
            .withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("bigint")))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences as Parquet, one folder per length: a reader takes batches of
    one length without padding."""
    pieces.write.partitionBy("bucket").parquet(path)
