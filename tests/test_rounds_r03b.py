"""What moved, sorted or searched more than it had to in round 3."""

import re

from test_rounds_r03 import shuffled_columns

from microblog.config import scratch_path
from microblog.sinks import keyed


def nodes(df, name: str) -> int:
    return len(re.findall(rf"\b{name}\b", df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]))


def test_a_fold_moves_and_sorts_its_rows_once(spark, monkeypatch):
    path = scratch_path(spark, "fold-once")
    schema = "_id STRING, text STRING, n INT"
    rows = [(f"k{i}", f"t{i}", i) for i in range(40)] + [(None, "no key", 1), ("k3", "t9", 0)]
    keyed.upsert_batch(spark.createDataFrame(rows, schema), path, 0)
    keyed.upsert_batch(spark.createDataFrame([("k1", "new", 1), (None, "still none", 0), ("k1", "new", 0)], schema), path, 1)
    want = sorted(map(str, [*[(k, t, n) for k, t, n in rows[:40] if k not in ("k1", "k3")], ("k1", "new", 1), ("k3", "t9", 0), (None, "still none", 0)]))
    assert nodes(keyed.latest(spark, path), "Sort") == 1
    assert sorted(map(str, map(tuple, keyed.latest(spark, path).collect()))) == want
    written, real = [], keyed._write_dealt
    monkeypatch.setattr(keyed, "_write_dealt", lambda df, *a, **k: (written.append(df.sortWithinPartitions(keyed.BUCKET_COL, "_id")), real(df, *a, **k)))
    keyed.fold(spark, path)
    assert len(shuffled_columns(written[0])) == 1 and nodes(written[0], "Sort") == 1
    assert sorted(map(str, map(tuple, keyed.latest(spark, path).collect()))) == want
    keyed.upsert_batch(spark.createDataFrame([("k2", "newer", 5)], schema), path, 2)
    want = [w for w in want if "'k2'" not in w] + [str(("k2", "newer", 5))]
    assert nodes(keyed.latest(spark, path), "SortMergeJoin") == 0
    assert sorted(map(str, map(tuple, keyed.latest(spark, path).collect()))) == sorted(want)
    keyed.fold(spark, path, bucket_bytes=1)  # buckets in parts; the old snapshot moves once too
    assert len(shuffled_columns(written[1])) == 1
    assert sorted(map(str, map(tuple, keyed.latest(spark, path).collect()))) == sorted(want)
    assert "Aggregate" not in keyed.latest(spark, path)._jdf.queryExecution().optimizedPlan().toString()


def test_single_features_of_the_head_are_one_weight_and_agree(spark, monkeypatch):
    """Weights of features that one example has are kept once for all of them,
    also in the head; they are those that every feature for itself gets."""
    from microblog.operators import softmax
    from microblog.operators import vocab as V

    rows = [(i, i % 3, " ".join([["good", "bad", "so"][i % 3], f"w{i % 7}", f"own{i} own{i}", f"own{i}x", f"own{i}y", f"pair{i // 2}"])) for i in range(24)]
    ex = spark.createDataFrame([*rows, (30, 1, None), (31, 2, "alone")], "id BIGINT, label INT, text STRING")
    vocab = V.build(ex).cache()
    feats = softmax.features(V.encode(ex, vocab)).join(ex.select("id", "label"), "id").cache()
    params = softmax.Params(steps=3)
    only = softmax.is_inner("id", params.seed)

    def learnt():
        at = softmax._Layout(feats)
        try:
            got = [{r.idx: r.asDict() for r in softmax._fit(at, (0.0, 0.01), params, o).collect()} for o in (None, ~only)]
            return got, at.docs.selectExpr("explode(feats.idx) AS idx").distinct().count(), at.far
        finally:
            at.drop()

    each, held, _ = learnt()
    monkeypatch.setattr(softmax, "MERGE_ROWS", 10)
    for head, far in ((softmax.HEAD_ROWS, False), (6, True)):
        monkeypatch.setattr(softmax, "HEAD_ROWS", head)
        one, fewer, beyond = learnt()
        assert fewer == held - 48 and (beyond is not None) == far
        for a, b in zip(each, one):
            assert a.keys() == b.keys()
            assert all(abs(a[i][c] - b[i][c]) < 1e-12 for i in a for c in a[i])
