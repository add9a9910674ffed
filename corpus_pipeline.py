"""The corpus pipeline: from documents to packed training sequences.

Stages, in order; each works on the rows that the stage before it kept, written
as Parquet and read again:

1. ``quality`` (Bradley-Terry ranking): rejected documents go.
2. ``toxicity`` (recurrent network): rejected documents go.
3. ``near_duplicates`` (bottom-k sketches): of each group the document with the
   smallest id stays.
4. ``packing`` (power-of-two decomposition): a row per sequence.

All but the last return the columns of ``documents``. Labels are learnt from
where crc32(doc_id) mod 5 is not 0. Definitions: the first two stages judge every
row by its own text, whatever its id; rows with a null id never count as
duplicates; rows that share an id are one document to the near-duplicate stage
and stay or go together; a stage on an empty table returns an empty one. Packed
sequences have their ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microblog.config import scratch_path
from microblog.llm import neardup, packing, quality, toxicity
from microblog.llm.common import fold, prepare, read_table, release_shuffles
from microblog.llm.queries import BYTE_BPE

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Text encoded at once while packing: executors still hold what the stages before took.
PACK_BYTES = 2 << 20


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold; every row is judged
    as it passes, so no text is shuffled."""
    prepare(spark)
    rest = COLUMNS[1:]
    scores = quality.scored(docs, read_table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != 0, carry=rest)
    return scores.where(F.col("score") >= quality.CUT).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a toxic window; every row is scored as it passes."""
    prepare(spark)
    rest = COLUMNS[1:]
    scores = toxicity.scored(docs, read_table(spark, sf_dir, "labels"), fold(F.col("doc_id")) != 0, carry=rest)
    return scores.where(F.col("score") < toxicity.CUT).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; rows without an id stay."""
    prepare(spark)
    gone = neardup.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids as sequences of binary lengths, 1024 at most."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN, block_bytes=PACK_BYTES)


STAGES = [("quality", keep_quality), ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("packing", pack)]

#: Trained models and tokenizers are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, with a written table between two."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            release_shuffles(spark)  # what the stage held is not the next one's to hold
    return docs
