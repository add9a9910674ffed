"""What took a row per token or feature in round 4."""

import numpy as np
from test_rounds_r03 import generated_columns

from microblog.operators import softmax
from microblog.operators import vocab as V


def test_encoding_makes_no_row_of_a_token(spark):
    train = spark.createDataFrame([(1, "b a a"), (2, "c a b")], "id BIGINT, text STRING")
    vocab = V.build(train).cache()
    rows = [(1, "a zzz　c"), (2, None), (3, " \t "), (4, " b\x1ca"), (5, "c b"), (5, "a")]
    enc = V.encode(spark.createDataFrame(rows, "id BIGINT, text STRING"), vocab)
    assert generated_columns(enc) == []
    assert {r.id: (r.ids, r.n_tokens) for r in enc.collect()} == {1: ([2, 0, 4], 3), 2: ([], 0), 3: ([], 0), 4: ([3, 2], 2), 5: ([2, 4, 3], 3)}


def test_lost_tokens_of_repeated_ids_keep_their_places(spark, monkeypatch):
    train = spark.createDataFrame([(1, "a a a b b c d e f")], "id BIGINT, text STRING")
    vocab = V.build(train).cache()
    docs = spark.createDataFrame([(1, "c a zz b"), (1, "zz f d"), (2, "f"), (3, "")], "id BIGINT, text STRING")
    whole = {r.id: r.ids for r in V.encode(docs, vocab).collect()}
    assert whole[1] == [0, 4, 2, 7, 0, 5, 3] and whole[2] == [7] and whole[3] == []
    monkeypatch.setattr(V, "HEAD_ROWS", 2)
    monkeypatch.setattr(V, "HEAD_BYTES", 2)
    assert {r.id: r.ids for r in V.encode(docs, vocab).collect()} == whole


def plain(rows, penalty, steps, params):
    """The same descent on all features at once: rows of (id, label, idx, x)."""
    ids, labels, idx, x = (np.array(c) for c in zip(*rows))
    n, w, v = (idx == softmax.BIAS).sum(), np.zeros((idx.max() + 1, 3)), np.zeros((idx.max() + 1, 3))
    for _ in range(steps):
        z = np.zeros((ids.max() + 1, 3))
        np.add.at(z, ids, x[:, None] * w[idx])
        p = np.exp(z - z.max(axis=1, keepdims=True))
        e = (p / p.sum(axis=1, keepdims=True))[ids] - (labels[:, None] == np.arange(3))
        g = np.zeros_like(w)
        np.add.at(g, idx, x[:, None] * e / n)
        v = v * params.momentum - (g + w * penalty * (np.arange(len(w)) != softmax.BIAS)[:, None]) * params.rate
        w = w + v
    return {i: w[i] for i in set(idx.tolist())}


def test_steps_make_no_row_of_a_feature_and_agree_with_a_plain_descent(spark, monkeypatch):
    """Also where an id comes twice and has two labels, in blocks of few examples,
    with weights beyond the head."""
    texts = [(i, i % 3, " ".join([["good", "bad", "so"][i % 3], f"w{i % 7}", f"w{i % 5}", f"pair{i // 2}", f"own{i}"])) for i in range(30)]
    ex = spark.createDataFrame(texts, "id BIGINT, label INT, text STRING")
    vocab = V.build(ex).cache()
    labels = spark.createDataFrame([*[(i, k) for i, k, _ in texts], (4, 1), (4, 2), (7, 1)], "id BIGINT, label INT")
    feats = softmax.features(V.encode(ex, vocab)).join(labels, "id").select("id", "label", "idx", "x").cache()
    params = softmax.Params(steps=3)
    want = [plain([tuple(r) for r in feats.collect()], p, 3, params) for p in (0.0, 0.01)]
    monkeypatch.setattr(softmax, "BLOCK_ROWS", 20, raising=False)
    made, real = [], softmax._Layout.bucketed
    monkeypatch.setattr(softmax._Layout, "bucketed", lambda self, df, key: (made.extend(generated_columns(df)), real(self, df, key))[1])
    for head in (softmax.HEAD_ROWS, 6):
        monkeypatch.setattr(softmax, "HEAD_ROWS", head)
        at = softmax._Layout(feats)
        try:
            made.clear()
            got = {r.idx: r for r in softmax._fit(at, (0.0, 0.01), params).collect()}
        finally:
            at.drop()
        assert not any("_f" in cols for cols in made)
        assert got.keys() == want[0].keys()
        assert all(abs(got[i][f"w{r}_{k}"] - w[k]) < 1e-12 for r in range(2) for i, w in want[r].items() for k in range(3))
