"""What grew faster than the input in round 3."""

from microblog.operators import topics


def generated_columns(df) -> list[list[str]]:
    """The output columns of every generator (explode) of a frame's plan."""
    out = []

    def walk(plan):
        if plan.nodeName() == "Generate":
            cols = plan.output()
            out.append([cols.apply(i).name() for i in range(cols.size())])
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    walk(df._jdf.queryExecution().optimizedPlan())
    return out


def shuffled_columns(df) -> list[list[str]]:
    """The output columns of every exchange of a frame's plan."""
    out = []

    def walk(plan):
        if "AdaptiveSparkPlan" in plan.nodeName():
            return walk(plan.executedPlan())
        if plan.nodeName() == "Exchange":
            cols = plan.output()
            out.append([cols.apply(i).name() for i in range(cols.size())])
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_phrases_copy_no_post_for_its_words(spark):
    rows = [(i, " ".join([f"w{i % 7}", "Red,", f"u{i}", "fox"])) for i in range(50)]
    posts = spark.createDataFrame([*rows, rows[0], (60, None)], "id BIGINT, text STRING")
    phrases = spark.createDataFrame([("red w1",), ("fox u3 red",), ("blue fox",), ("w0",)], "phrase STRING")
    want = sorted((i, p) for i, t in [*rows, rows[0]] for p in ("red w1", "fox u3 red", "blue fox", "w0")
                  if set(p.split()) <= set(t.lower().replace(",", "").split()))
    index = topics.phrase_index(phrases, posts)
    got = topics.track_phrases(posts, index)
    assert sorted((r.id, r.phrase) for r in got.collect()) == want
    assert not any("word" in cols and ("text" in cols or "_words" in cols) for cols in generated_columns(got))


def test_softmax_steps_shuffle_no_features_and_far_weights_agree(spark, monkeypatch):
    """Weights beyond the head, shared and of a single example, are those that
    one broadcast gives; the features are read where they lie."""
    from dataclasses import replace

    from microblog.operators import softmax
    from microblog.operators import vocab as V

    rows = [(i, i % 3, " ".join([["good", "bad", "so"][i % 3], f"w{i % 7}", f"w{i % 5}", f"own{i}", f"own{i}x", f"pair{i // 2}"])) for i in range(24)]
    ex = spark.createDataFrame(rows, "id BIGINT, label INT, text STRING")
    vocab = V.build(ex).cache()
    feats = softmax.features(V.encode(ex, vocab)).join(ex.select("id", "label"), "id").cache()
    params = replace(softmax.Params(), steps=3)

    def learnt():
        at = softmax._Layout(feats)
        try:
            got = {r.idx: r.asDict() for r in softmax._fit(at, (0.0, 0.01), params).collect()}
            return got, shuffled_columns(at.docs.groupBy("id").count()), at.alone
        finally:
            at.drop()

    near, moved, alone = learnt()
    assert alone is None and moved == []
    monkeypatch.setattr(softmax, "HEAD_ROWS", 6)
    far, moved, alone = learnt()
    assert alone.count() == 48 and moved == []
    assert near.keys() == far.keys()
    assert all(abs(near[i][c] - far[i][c]) < 1e-12 for i in near for c in near[i])


def test_bulk_change_points_ask_the_state_by_block():
    """A block of a window width is one entry of the state, however many panes."""
    from types import SimpleNamespace as N

    from microblog.streaming.timers import _ChangePoints

    class Map(dict):
        asked = 0
        containsKey = dict.__contains__

        def getValue(self, k):
            self.asked += 1
            return self[k]

        updateValue, removeKey = dict.__setitem__, dict.__delitem__

    class Value:
        v = None
        exists = lambda self: self.v is not None
        get = lambda self: self.v

        def update(self, v):
            self.v = v

        def clear(self):
            self.v = None

    blocks, timers = Map(), []
    handle = N(getMapState=lambda *_: blocks, getValueState=lambda *_: Value(), registerTimer=timers.append)
    p = _ChangePoints("k", 10, -1, True)
    p.init(handle)
    got = []
    for upto, secs in ((57, range(0, 57)), (81, range(57, 80)), (200, ())):
        list(p.handleInputRows(("a",), iter([N(sec=s, c=s + 1) for s in secs]), None))
        got += [(r.sec, r.n) for r in p.handleExpiredTimer(("a",), N(getCurrentWatermarkInMs=lambda: upto * 1000), None)]
    assert got == [(s, sum(t + 1 for t in range(80) if s - 10 < t <= s)) for s in range(90)]
    assert not blocks and blocks.asked <= 30
