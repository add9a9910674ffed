"""The findings on op8_packing's time and the pipeline's memory in round 3."""

import random
import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest

from microblog.llm import packing, pieces
from microblog.llm.common import BATCH_BYTES, BLOCK_BYTES, prepare
from microblog.llm.queries import BYTE_BPE

WORDS = r" ?\S+|\s+"


def words(**bounds):
    return pieces.PieceEncoder(WORDS, lambda found: [w.encode() for w in found], **bounds)


def test_repeated_pieces_are_no_objects_of_their_own():
    """Each distinct piece of a block is looked up once; the others are places
    in a column, not strings."""
    encode = words()
    encode(["a b", "c"])  # what is imported on first use
    texts = [" ".join(f"w{i % 97}" for i in range(1000 * k, 1000 * k + 20000)) for k in range(20)]
    tracemalloc.start()
    try:
        got = encode(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == [t.encode() for t in texts]
    assert peak < 6 * sum(map(len, texts)), peak


@pytest.mark.parametrize("bounds", [{}, {"entries": 20, "chars": 400}])
def test_spaces_in_any_place_cut_no_match(bounds):
    encode, rng = words(**bounds), random.Random(5)
    parts = [" ", "  ", "\n", "\t ", " ", "　", "\x1f", "a", "the", "été", ".", "!!", "12", "\U0001f642", ""]
    for _ in range(40):
        texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(rng.randrange(25))]
        assert encode(texts) == [t.encode() for t in texts]


def test_packing_in_smaller_blocks_gives_the_same_rows(spark, monkeypatch):
    import corpus_pipeline as pipe

    prepare(spark)
    rows = [(i, " ".join(f"word{j * i % 23}," for j in range(60 * i))) for i in range(8)] + [(None, None), (3, "a  b\n c"), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").coalesce(1)
    whole = packing.pack(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN).collect()
    for size in (1, 700):
        monkeypatch.setattr(pipe, "PACK_BYTES", size)
        assert pipe.pack(spark, docs, "").collect() == whole


def test_rows_reach_tasks_in_batches_of_a_blocks_size(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([b.nbytes], pa.int64())], names=["n", "size"])

    fresh = spark.newSession()
    prepare(fresh)
    docs = fresh.range(0, 10_000, 1, 1).selectExpr("id", "repeat('a text ', 500) AS text")
    got = docs.mapInArrow(sizes, "n BIGINT, size BIGINT").collect()
    assert sum(r.n for r in got) == 10_000 and max(r.size for r in got) < 1.1 * BLOCK_BYTES
    fresh.conf.set(BATCH_BYTES, "1000000")
    prepare(fresh)
    assert fresh.conf.get(BATCH_BYTES) == "1000000"
