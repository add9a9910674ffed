"""Vocabulary lookups: the size-checked single broadcast and the head/tail
path for large vocabularies give the same encodings."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from microblog.operators import prep
from microblog.operators import vocab as V


def _collect(df, col):
    return {r["id"]: r[col] for r in df.collect()}


def test_head_tail_lookup_equals_single_broadcast(spark, monkeypatch):
    ex = prep.examples(spark, SF_SMALL)
    vocab = V.build(prep.split(ex)[0])
    enc_small = _collect(V.encode(ex, vocab), "ids")
    dec_small = _collect(V.decode(V.encode(ex, vocab), vocab), "text")
    monkeypatch.setattr(V, "HEAD_ROWS", 5)            # most tokens now live in the tail
    monkeypatch.setattr(V, "HEAD_TOKEN_BYTES", 3)     # and long tokens never enter the head
    monkeypatch.setattr(V, "HEAD_BYTES", 15)
    assert not V._fits_whole(vocab.select("token", "idx"), "token")
    enc_big = _collect(V.encode(ex, vocab), "ids")
    dec_big = _collect(V.decode(V.encode(ex, vocab), vocab), "text")
    assert enc_big == enc_small
    assert dec_big == dec_small


def test_unknown_pad_and_first_index(spark):
    train = spark.createDataFrame([(1, "b a a"), (2, "c a b")], "id BIGINT, text STRING")
    vocab = V.build(train)
    got = {r.token: r.idx for r in vocab.collect()}
    assert got == {"a": 2, "b": 3, "c": 4}       # freq desc, token asc, first real index 2
    probe = spark.createDataFrame([(9, "a zzz c"), (10, "")], "id BIGINT, text STRING")
    enc = _collect(V.encode(probe, vocab), "ids")
    assert enc == {9: [2, 0, 4], 10: []}
    batched = V.batches(V.lengths(train.unionByName(probe)))
    padded = {r.id: r.padded for r in V.pad(batched, V.encode(train.unionByName(probe), vocab)).collect()}
    assert padded[10] == [1, 1, 1] and padded[9] == [2, 0, 4]
    dec = _collect(V.decode(V.encode(probe, vocab), vocab), "text")
    assert dec == {9: "a <unk> c", 10: ""}


def test_one_heavy_unknown_token_stays_off_the_shuffle(spark, monkeypatch):
    """One unknown token is 90 % of all occurrences: no task of the tail join
    reads more than twice the median, and the result is that of the broadcast."""
    import re

    words = [f"w{i}" for i in range(2000)]
    train = spark.createDataFrame([(i, " ".join(words[i % 50::50])) for i in range(100)], "id BIGINT, text STRING")
    vocab = V.build(train)
    docs = spark.createDataFrame([(i, " ".join(["unheard"] * 360 + words[i % 50::50])) for i in range(200)], "id BIGINT, text STRING")
    whole = _collect(V.encode(docs, vocab), "ids")
    assert whole[3][:360] == [0] * 360 and 0 not in whole[3][360:]
    monkeypatch.setattr(V, "HEAD_ROWS", 20)
    monkeypatch.setattr(V, "HEAD_BYTES", 100)
    monkeypatch.setattr(V, "HEAVY_KEYS", 3)
    asked = {}
    real = V._heavy

    def heavy(misses, key, tail, value):
        asked["misses"] = misses
        return real(misses, key, tail, value)

    monkeypatch.setattr(V, "_heavy", heavy)
    enc = V.encode(docs, vocab)
    assert _collect(enc, "ids") == whole
    heavy_rows = real(asked["misses"], "token", vocab.where("idx >= 22").select("token", F.col("idx").alias("_tv")), "_tv")
    assert heavy_rows.count() == 3
    rest = asked["misses"].withColumn("_d", V._digest("token")).join(heavy_rows, "_d", "left_anti")
    sizes = sorted(r["count"] for r in rest.repartition(8, "token").groupBy(F.spark_partition_id()).count().collect())
    assert asked["misses"].count() > 10 * rest.count() * 0.8  # the heavy token was most of it
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_models_are_tuned_inside_the_training_split(spark):
    from dataclasses import replace

    from microblog.operators import sentiment, softmax

    train, test = prep.split(prep.examples(spark, SF_SMALL))
    vocab = V.build(train)
    rows = prep.stored(softmax.features(V.encode(train, vocab)).join(train.select("id", "label"), "id"), "features")
    params = replace(softmax.Params(), steps=3, penalties=(0.0, 5.0))
    best, found = softmax.choose(rows, train, params)
    assert best == min(range(2), key=lambda r: found[r]) and len(found) == 2
    again = softmax.choose(rows, train, replace(params, seed=7))[1]
    assert again != found  # the seed draws the inner split
    weights = softmax.train(train.filter("id < 0"), vocab)  # nothing to learn from: all scores are equal
    got = softmax.score(test.limit(3), vocab, weights).collect()
    assert {r.sentiment for r in got} == {0}
    strength = sentiment.tuned(train, replace(sentiment.TrainParams(), max_iter=2), (0.1, 0.3)).reg_param
    assert strength in (0.1, 0.3)


def test_softmax_beats_the_label_frequencies(spark):
    import math

    from microblog.operators import softmax

    rows = [(i, i % 3, " ".join(["good", "bad", "so"][i % 3:][:1] * 3 + [f"w{i % 7}"])) for i in range(90)]
    ex = spark.createDataFrame(rows, "id BIGINT, label INT, text STRING")
    vocab = V.build(ex)
    weights = softmax.train(ex, vocab)
    got = softmax.evaluate(ex, vocab, weights).collect()
    assert len(got) == 3 and all(r.n == 30 and r.log_loss < 0.5 * math.log(3) for r in got)
    odd = spark.createDataFrame([(1, "good new words"), (2, "  "), (3, None), (4, "")], "id BIGINT, text STRING")
    assert {r.id: r.sentiment for r in softmax.score(odd, vocab, weights).collect()} == {1: 0, 2: -1, 3: -1, 4: -1}
