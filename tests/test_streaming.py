"""Stream = batch by replay, restarts, idempotent upserts, late data."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from microblog.config import scratch_path
from microblog.sinks import keyed
from tools.oracle_check import compare

Q, O = E.queries(), E.oracle_sql()


def check(spark, duck, name):
    problems, _, n = compare(spark, duck, name, Q[name], O[name], SF_SMALL)
    assert not problems, problems
    return n


def test_raw_append_equals_batch(spark, duck_small):
    assert check(spark, duck_small, "stream_raw_append") > 0


def test_chained_sliding_window_equals_batch(spark, duck_small):
    assert check(spark, duck_small, "stream_hashtags_sliding") > 0


def test_live_change_points_equal_batch_sliding_count(spark, duck_small):
    assert check(spark, duck_small, "stream_hashtags_change_points") > 0


def test_complete_mode_top_and_average(spark, duck_small):
    check(spark, duck_small, "stream_top_complete")
    check(spark, duck_small, "stream_avg_followers")


def test_restart_from_checkpoint_equals_single_run(spark, duck_small):
    check(spark, duck_small, "stream_restart_equals_single_run")


def test_late_rows_are_dropped_like_the_batch_rule(spark, duck_small):
    n = check(spark, duck_small, "late_rows_dropped")
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert n < total


def test_upsert_batch_is_idempotent(spark):
    path = scratch_path(spark, "upsert-test")
    b0 = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "_id STRING, text STRING, sentiment INT")
    b1 = spark.createDataFrame([("a", "x2", 0)], "_id STRING, text STRING, sentiment INT")
    keyed.upsert_batch(b0, path, 0)
    keyed.upsert_batch(b1, path, 1)
    keyed.upsert_batch(b1, path, 1)   # replayed batch after a failure
    rows = {r._id: (r.text, r.sentiment) for r in keyed.latest(spark, path).collect()}
    assert rows == {"a": ("x2", 0), "b": ("y", 2)}


def test_score_upsert_stream_routes_bad_records(spark):
    df = Q["score_upsert_stream"](spark, SF_SMALL)
    rows = df.collect()
    n_events = spark.read.parquet(f"{SF_SMALL}/events.parquet").join(
        spark.read.parquet(f"{SF_SMALL}/documents.parquet"), F.col("event_id") == F.col("doc_id")).count()
    # id % 10 in {0, 1} are dead letters; all others stored once
    assert len(rows) == len({r._id for r in rows}) == n_events - n_events // 5
    assert {r.sentiment for r in rows} <= {0, 1, 2}


def test_live_dashboards_run_on_a_file_stream(spark, capsys):
    from microblog import schema
    from microblog.operators import topics, windows
    from microblog.streaming import live
    from microblog.streaming.replay import Replay

    rp = Replay(spark, "dashboards").stage_by_time(schema.tweets(spark, SF_SMALL), 2)
    rp.arrive(0)
    rp.arrive(1)
    qs = live.start_dashboards(rp.stream(), rp.checkpoint, interval="0 seconds", delay="1 hour",
                               width=3600, slide=600)
    try:
        for q in qs:
            q.processAllAvailable()
            assert q.exception() is None
    finally:
        for q in qs:
            q.stop()
    out = capsys.readouterr().out
    ranked = [line.split() for line in out.splitlines() if line.split()[2:3] and line.split()[2].startswith("#")]
    by_force = topics.hashtag_rows(schema.english(schema.tweets_base(spark, SF_SMALL)), keep=("sec",))
    want = {(str(r.window_end), str(r.rank), r.token, str(r.n)) for r in windows.top_per_window(
        windows.dense_sliding_count(by_force, "token", 3600, 600), "token").collect()}
    assert ranked and {tuple(x) for x in ranked} <= want


def test_scored_documents_keep_the_original_text(spark):
    from microblog import schema

    docs = Q["score_upsert_stream"](spark, SF_SMALL)
    orig = schema.tweets_base(spark, SF_SMALL).select(F.concat("id_str", F.lit("12345")).alias("_id"),
                                                      F.col("text").alias("orig"))
    j = docs.join(orig, "_id")
    assert j.count() == docs.count() and j.filter(F.col("text") != F.col("orig")).count() == 0


def test_watermark_drop_count_matches_missing_rows(spark):
    from microblog.plans import catalog_stream as CS
    from microblog.streaming import live
    from microblog.streaming.replay import Replay

    ev = CS._followers(spark, SF_SMALL)
    rp = Replay(spark, "late-count").stage(ev, F.when(F.col("event_id") % 3 != 0, 0).otherwise(1))
    flush = ev.agg(F.max("created_at").alias("m")).select(
        F.lit(-1).cast("bigint").alias("event_id"), (F.col("m") + F.expr("INTERVAL 30 DAYS")).alias("created_at"),
        F.lit(None).cast("bigint").alias("sec"), F.lit(None).cast("int").alias("followers_count"))
    rp.replay(2, lambda s: live.late_panes(s, CS.LATE_DELAY).writeStream.format("parquet")
              .option("path", rp.output).outputMode("append"), flush=flush)
    last = ev.agg(F.max("sec")).first()[0]
    kept = spark.read.parquet(rp.output).filter(F.col("sec") <= last).agg(F.sum("n")).first()[0]
    # every real row was either counted in an emitted pane or dropped as late
    assert rp.dropped_by_watermark() > 0
    assert kept + rp.dropped_by_watermark() == ev.count()
