"""What was held longer than it was needed in round 3."""

import zlib

import numpy as np

from microblog.llm import ngrams, toxicity


def test_a_block_to_be_traversed_keeps_counts_alone():
    tokens = np.array([1, 2, 1, 2, 0], np.uint32)
    row = {"words": zlib.compress(b"\n a b"), "tokens": zlib.compress(ngrams._planes(tokens)), "sizes": [5], "learn": [True]}
    b, kept = ngrams._Block(row), ngrams._Block(row)
    counts = np.bincount(b.at).astype(np.uint64)
    b.answered(counts, last=True)
    kept.answered(counts)
    assert (b.count == kept.count).all() and (b.starts == kept.starts).all()
    assert not hasattr(b, "keys") and not hasattr(b, "gram") and len(kept.keys)


def test_the_driver_gives_memory_back_between_stages_and_before_training(spark, monkeypatch, tmp_path):
    import corpus_pipeline

    said = []
    spark.createDataFrame([(1, "a")], "doc_id BIGINT, text STRING").write.parquet(str(tmp_path / "documents.parquet"))
    stage = lambda name: (name, lambda s, docs, d: (said.append(name), docs)[1])
    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage("one"), stage("two"), stage("three")])
    monkeypatch.setattr(corpus_pipeline, "release_shuffles", lambda s: said.append("back"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 1
    assert said == ["one", "back", "two", "back", "three"]

    said.clear()
    monkeypatch.setattr(toxicity, "release_shuffles", lambda s: said.append("back"))
    monkeypatch.setattr(toxicity.Trainer, "fit", lambda *a, **k: said.append("fit"))
    rows = [(i % 2, i % 4 > 1, f"word{i} or {i}", i) for i in range(12)]
    toxicity.learnt(spark.createDataFrame(rows, "y INT, aside BOOLEAN, text STRING, print BIGINT"), {0: 6, 1: 6})
    assert said == ["back", "fit"] * toxicity.PHASES
