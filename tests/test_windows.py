"""Sliding counts and ordered helpers against brute force."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from microblog.operators import indexing, windows


def brute_sliding(arrivals, width, additive=False):
    pts = sorted(set(arrivals) | {a + width for a in arrivals})
    out = {}
    for t in pts:
        if additive:
            out[t] = sum(1 for a in arrivals if a <= t) + sum(1 for a in arrivals if a <= t - width)
        else:
            out[t] = sum(1 for a in arrivals if t - width < a <= t)
    return out


def run(spark, arrivals, **kw):
    df = spark.createDataFrame([("k", a) for a in arrivals], "token STRING, sec BIGINT")
    return {r.sec: r.n for r in windows.sliding_count(df, "token", **kw).collect()}


def test_golden_change_points(spark):
    arr = [0, 10, 10, 400]
    assert run(spark, arr) == {0: 1, 10: 3, 300: 2, 310: 0, 400: 1, 700: 0}
    assert run(spark, arr, keep_zero=False) == {0: 1, 10: 3, 300: 2, 400: 1}
    assert run(spark, arr, inverse="add") == {0: 1, 10: 3, 300: 4, 310: 6, 400: 7, 700: 8}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=3000), min_size=1, max_size=40), st.booleans())
def test_sliding_matches_brute_force(spark, arrivals, additive):
    got = run(spark, arrivals, width=300, inverse="add" if additive else "subtract")
    assert got == brute_sliding(arrivals, 300, additive)


def test_prefix_sum_across_blocks_matches_cumsum(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("ab"), rnd.randrange(0, 5000), rnd.randrange(-3, 9)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k STRING, t BIGINT, v BIGINT")
    got = {(r.k, r.t): r.s for r in indexing.prefix_sum(df, ["k"], "t", "v", "s", block=97, last_per_order=True).collect()}
    for (k, t), s in got.items():
        assert s == sum(v for kk, tt, v in rows if kk == k and tt <= t)
    assert len(got) == len({(k, t) for k, t, _ in rows})


def test_prefix_sum_hot_key_spreads_over_blocks(spark):
    # one key holding most rows is split into many (key, block) window partitions
    df = spark.range(0, 20000).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.lit(1).cast("bigint").alias("v"))
    res = indexing.prefix_sum(df, ["k"], "t", "v", "s", block=1000)
    assert res.agg(F.max("s")).first()[0] == 20000
    assert res.filter(F.col("s") != F.col("t") + 1).count() == 0


def test_global_rank_is_total_order_position(spark):
    rnd = random.Random(3)
    rows = [(f"w{rnd.randrange(500)}", rnd.randrange(50)) for _ in range(2000)]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, "token STRING, freq BIGINT")
    got = {r.token: r.rank for r in indexing.global_rank(df, [F.desc("freq"), F.asc("token")], num_partitions=7).collect()}
    expect = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == {t: i + 1 for i, (t, _) in enumerate(expect)}


def test_dense_windows_match_brute_force(spark):
    rnd = random.Random(5)
    arr = [rnd.randrange(0, 20000) for _ in range(300)]
    df = spark.createDataFrame([("k", a) for a in arr], "token STRING, sec BIGINT")
    width, slide = 3600, 600
    got = {r.window_end: r.n for r in windows.dense_sliding_count(df, "token", width, slide).collect()}
    ends = {e for a in arr for e in range((a // slide) * slide + slide, (a // slide) * slide + width + 1, slide)}
    expect = {e: sum(1 for a in arr if e - width <= a < e) for e in ends}
    assert got == {e: n for e, n in expect.items() if n}


def test_top_per_window_limits_each_window(spark):
    rows = [(t, s) for s in range(0, 7200, 7) for t in ("#a", "#b", "#c") if (s + len(t)) % 3]
    df = spark.createDataFrame(rows, "token STRING, sec BIGINT")
    top = windows.top_per_window(windows.dense_sliding_count(df, "token", 3600, 1800), "token", k=2)
    per = top.groupBy("window_end").count().collect()
    assert per and all(r["count"] <= 2 for r in per)


def test_prefix_sum_counts_null_keys_and_leaves_out_null_times(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 5, 3), ("a", 1, 4), ("a", None, 9)], "k STRING, t BIGINT, v BIGINT")
    got = sorted((r.k or "", r.t, r.s) for r in indexing.prefix_sum(df, ["k"], "t", "v", "s", block=2).collect())
    assert got == [("", 1, 2), ("", 5, 5), ("a", 1, 4)]
