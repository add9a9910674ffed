"""The findings on the pipeline's memory and on op7_bottom_k's pairs in round 3."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from microblog.llm import neardup, quality
from microblog.llm.common import prepare
from test_operators import near_by_force, sentence


@pytest.fixture(scope="module", autouse=True)
def folder(spark):
    prepare(spark)


def test_texts_with_much_of_their_own_beside_a_passage_make_no_pairs(spark, monkeypatch):
    """The passage is in every text's deciding values; what stands before it
    says that no two of them can be similar enough."""
    passage = sentence(31, 64)
    rows = [(i, f"{passage} {sentence(3000 + i, 14)}") for i in range(80)]
    other = sentence(32, 64)
    rows += [(500 + i, f"{other} {sentence(4000 + i, 4)}") for i in range(20)]  # these are
    seen = []
    found = neardup._Links.likely
    monkeypatch.setattr(neardup._Links, "likely", lambda self, pairs: (seen.append(pairs.count()), found(self, pairs))[1])
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in neardup.near_duplicates(docs, short=4).collect())
    assert got == near_by_force(rows)
    assert len(seen) > 1 and not any(seen[1:]), seen


def test_quality_of_the_pipeline_joins_and_shuffles_no_text(spark, tmp_path):
    import corpus_pipeline as pipe

    ddl = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    bad = lambda t: t.replace(" ", "$$$ ")
    rows = [(i, [bad, str][i % 2](sentence(i, 60)), "en", None, i) for i in range(60)]
    rows += [rows[1], (2, rows[3][1], None, "s", 7), (None, None, None, None, None), (None, rows[5][1], "fr", "s", 1), (70, "", "en", "s", 0), (70, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, ddl)
    spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id BIGINT, quality INT").write.parquet(str(tmp_path / "labels.parquet"))
    good = pipe.keep_quality(spark, docs, str(tmp_path))
    plan = good._jdf.queryExecution().toString()
    assert not re.search(r"Join|Exchange", plan), plan
    scores = quality.scored(docs, spark.read.parquet(str(tmp_path / "labels.parquet")), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0, carry=("text",))
    kept = {(r.doc_id, r.text) for r in scores.where(F.col("score") >= quality.CUT).collect()}
    assert collections.Counter(map(tuple, good.collect())) == collections.Counter(r for r in rows if r[:2] in kept)
    assert good.count() and {r[:2] for r in rows} - kept
