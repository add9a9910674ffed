"""Keyed window state with timers, late rows, observed counts, the directory
source: what happens between batches, after restarts and after losses."""

import datetime
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from microblog import schema
from microblog.functions import json as J
from microblog.operators import windows
from microblog.sinks import folders, keyed
from microblog.sources import directory
from microblog.streaming import late, live, timers
from microblog.streaming.replay import Replay
from tools.oracle_check import compare

Q, O = E.queries(), E.oracle_sql()
EVENTS = "created_at TIMESTAMP, sec BIGINT, token STRING"


def at(sec):
    return datetime.datetime.fromtimestamp(sec, datetime.timezone.utc)


def events(spark, rows):
    return spark.createDataFrame([(at(s), s, t) for s, t in rows], EVENTS)


def start(spark, name):
    rp = Replay(spark, name)
    rp.schema = spark.createDataFrame([], EVENTS).schema
    return rp


def change_points(rp, **options):
    def build(s):
        return (timers.change_points(s, "token", "0 seconds", **options).writeStream.outputMode("append")
                .format("parquet").option("path", rp.output))

    with timers.state_store(rp.spark):
        rp.run(build)


def points(rp):
    return {(r.token, r.sec): r.n for r in rp.spark.read.parquet(rp.output).collect()}


@pytest.mark.parametrize("name", ["stream_verified_change_points", "stream_mentions_additive_change_points", "stream_top_per_slide",
                                  "late_corrections", "stream_message_counts", "directory_posts"])
def test_stream_equals_its_sql(spark, duck_small, name):
    problems, _, n = compare(spark, duck_small, name, Q[name], O[name], SF_SMALL)
    assert not problems and n


def test_a_drop_to_zero_needs_no_later_row_of_its_key(spark):
    rp = start(spark, "drop-to-zero")
    rp.arrive_frame(events(spark, [(100, "#a"), (100, "#a"), (110, "#a"), (120, "#b")]))
    change_points(rp)
    rp.arrive_frame(events(spark, [(5_000, "#flush")]))  # one row of another key
    change_points(rp)
    assert {k: n for k, n in points(rp).items() if k[0] != "#flush"} == {
        ("#a", 100): 2, ("#a", 110): 3, ("#a", 400): 1, ("#a", 410): 0, ("#b", 120): 1, ("#b", 420): 0}


def test_zeros_go_and_inverses_add(spark):
    rp = start(spark, "zeros-go")
    rp.arrive_frame(events(spark, [(0, "#a"), (7, "#a"), (9_000, "#x")]))
    change_points(rp, keep_zero=False, width=5)
    rp.arrive_frame(events(spark, [(20_000, "#flush")]))
    change_points(rp, keep_zero=False, width=5)
    assert {k: n for k, n in points(rp).items() if k[0] == "#a"} == {("#a", 0): 1, ("#a", 7): 1}
    rp = start(spark, "adds")
    rp.arrive_frame(events(spark, [(0, "#a"), (7, "#a"), (9_000, "#flush")]))
    change_points(rp, inverse="add", width=5)
    assert {k: n for k, n in points(rp).items() if k[0] == "#a"} == {("#a", 0): 1, ("#a", 5): 2, ("#a", 7): 3, ("#a", 12): 4}
    with pytest.raises(ValueError):
        timers.change_points(events(spark, []), "token", "0 seconds", inverse="divide")


def test_lost_state_fails_the_query(spark):
    rp = start(spark, "lost-state")
    rp.arrive_frame(events(spark, [(10, "#a")] * 5))
    change_points(rp)
    shutil.rmtree(f"{rp.checkpoint.removeprefix('file:')}/state")
    rp.arrive_frame(events(spark, [(20, "#a"), (9_000, "#flush")]))
    with pytest.raises(Exception):
        change_points(rp)


def test_state_store_setting_comes_back(spark):
    before = spark.conf.get(timers.PROVIDER, None)
    with timers.state_store(spark):
        assert spark.conf.get(timers.PROVIDER) == timers.ROCKS_DB
    assert spark.conf.get(timers.PROVIDER, None) == before


@pytest.mark.parametrize("width,slide", [(30, 10), (20, 20), (25, 10)])
def test_live_ranking_equals_batch_over_many_batches(spark, width, slide):
    rng = random.Random(width)
    rows = [(t + rng.randint(0, 3), f"@{rng.choice('aaaabbbcdefghijklm')}") for t in range(0, 400, 2)]
    rows = [r for r in rows if not 150 < r[0] < 280]  # a silent time
    rp = start(spark, f"tops-{width}-{slide}")

    def build(s):
        return (timers.salted_tops(s, "token", "5 seconds", width, slide, k=3, salts=4).writeStream.outputMode("append")
                .foreachBatch(live.tops_writer(rp.output, "token", 3)))

    with timers.state_store(spark):
        for lo, hi in ((0, 90), (90, 91), (91, 300), (300, 500)):
            rp.arrive_frame(events(spark, [r for r in rows if lo <= r[0] < hi]))
            rp.run(build)
        rp.arrive_frame(events(spark, [(9_000, "@flush")]))
        rp.run(build)
    got = {tuple(r) for r in spark.read.parquet(rp.output).drop("batch_id").where("token <> '@flush'").collect()}
    want = windows.top_per_window(windows.dense_sliding_count(events(spark, rows), "token", width, slide), "token", 3)
    assert got == {tuple(r) for r in want.collect()}


def test_late_rows_are_kept_and_a_lost_horizon_fails(spark):
    root = Replay(spark, "late").root
    write = late.split_writer(root, delay_ms=10_000)
    sch = spark.createDataFrame([], EVENTS).schema
    write(events(spark, [(100, "#a"), (200, "#a")]), 0)  # no horizon yet: nothing is late
    second = events(spark, [(189, "#a"), (188, "#a"), (190, "#a"), (500, "#b")]).unionByName(spark.createDataFrame([(None, None, "#n")], EVENTS))
    write(second, 1)
    write(second, 1)  # replayed
    got = sorted(r.sec or 0 for r in late.late_rows(spark, root, sch).collect())
    assert got == [0, 188, 189]  # panes that ended by second 190
    write(events(spark, []), 2)  # an empty batch hands the horizon on
    write(events(spark, [(489, "#a"), (490, "#a")]), 3)
    assert [r.sec for r in late.late_rows(spark, root, sch).where("sec > 300").collect()] == [489]
    with pytest.raises(RuntimeError):
        write(events(spark, []), 9)


def test_corrections_are_signed_rows_of_the_same_windows(spark):
    emitted = spark.createDataFrame([("#a", 20, 3), ("#b", 20, 1)], "token STRING, window_end BIGINT, n BIGINT")
    changes = late.corrections(events(spark, [(5, "#a"), (15, "#c")]), "token", 20, 10)
    got = {(r.token, r.window_end): r.n for r in late.corrected(emitted, changes, "token").collect()}
    assert got == {("#a", 20): 4, ("#b", 20): 1, ("#a", 10): 1, ("#c", 20): 1, ("#c", 30): 1}


def test_observed_counts_equal_the_dead_letter_split(spark):
    env = schema.bad_record_envelope(spark, SF_SMALL).select("value")
    want = {r.reason: r.n for r in J.route(env).groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert {r.reason: r.n for r in Q["stream_message_counts"](spark, SF_SMALL).collect()} == want


def test_directory_source_finds_every_post_once_over_restarts(spark, tmp_path):
    posts = schema.tweets(spark, SF_SMALL).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    folder, archive, out = (str(tmp_path / x) for x in ("in", "archive", "out"))
    ids = [r.id_str for r in posts.select("id_str").collect()]
    for i in range(4):
        part = posts.where((F.col("id_str").cast("bigint") % 4) == i)
        part.repartition(2).write.mode("append").json(folder)
        frame = directory.read_posts(spark, folder, max_files_per_trigger=1, archive=archive)
        q = (live.raw_posts(frame).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(availableNow=True).start())
        q.awaitTermination()
        assert len(q.recentProgress) >= 2  # a file at a time
    got = [r.id_str for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted(ids)
    assert sum(f.endswith(".json") for _, _, fs in os.walk(archive) for f in fs)  # done files have moved
    for bad in (dict(fmt="csv"), dict(archive="x", delete=True)):
        with pytest.raises(ValueError):
            directory.read_posts(spark, folder, **bad)


def test_dead_letters_never_reach_the_model(spark):
    seen = []

    def scorer(docs):
        seen.extend(r._id for r in docs.collect())
        return docs.withColumn("sentiment", F.lit(1))

    rp = Replay(spark, "dead-letters")
    rows = [('{"id_str":"1","text":"short id"}', 0), ("no json", 1), ('{"id_str":"0000000000000000007"}', 2),
            ('{"id_str":"0000000000000000008","text":"old"}', 3), ('{"id_str":"0000000000000000008","text":"new"}', 4)]
    env = spark.createDataFrame(rows, "value STRING, offset BIGINT").withColumn("value", F.col("value").cast("binary"))
    live.document_writer(f"{rp.root}/t", f"{rp.root}/d", scorer)(live.routed_documents(env), 0)
    key = "0000000000000000008" + "12345"
    assert seen == [key]
    assert [(r._id, r.text) for r in keyed.latest(spark, f"{rp.root}/t").collect()] == [(key, "new")]
    assert sorted(r.status for r in spark.read.parquet(f"{rp.root}/d").collect()) == ["bad_json", "bad_key", "missing_field"]
    assert folders.numbers(spark, f"{rp.root}/t", "snapshot") == [0]
