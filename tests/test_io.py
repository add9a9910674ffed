"""Sources and sinks: Kafka settings and record shape, CSV, vocabulary, keyed tables."""

from pyspark.sql import functions as F

from microblog import schema
from microblog.config import scratch_path
from microblog.functions import json as J
from microblog.sinks import files as sink_files
from microblog.sinks import keyed
from microblog.sources import files as src_files
from microblog.sources import kafka

from conftest import SF_SMALL


def test_kafka_source_and_sink_options():
    src = kafka.source_options("broker:9092", "t")
    assert src["subscribe"] == "t" and src["startingOffsets"] == "latest"
    assert not {"maxOffsetsPerTrigger", "failOnDataLoss", "kafka.group.id"} & set(src)
    assert kafka.source_options("b", "t", max_offsets_per_trigger=5)["maxOffsetsPerTrigger"] == "5"
    snk = kafka.sink_options("broker:9092", "t")
    assert snk["kafka.acks"] == "all" and snk["kafka.enable.idempotence"] == "true"
    assert snk["kafka.compression.type"] == "gzip" and snk["kafka.linger.ms"] == "20"
    assert snk["kafka.batch.size"] == str(32 * 1024)


def test_records_round_trip_through_json(spark):
    posts = schema.tweets(spark, SF_SMALL)
    rec = kafka.to_records(posts)
    assert rec.columns == ["key", "value"]
    back = J.route(rec, "value")
    assert back.filter(F.col("reason") != "ok").count() == 0
    assert back.select("id_str", "text").exceptAll(posts.select("id_str", "text")).count() == 0


def test_dead_letter_reasons(spark):
    env = schema.bad_record_envelope(spark, SF_SMALL)
    counts = {r.reason: r["count"] for r in J.route(env.select("offset", "value")).groupBy("reason").count().collect()}
    assert set(counts) == {"ok", "missing_field", "bad_json"}


def test_csv_round_trip_keeps_spaces_and_rows(spark):
    path = scratch_path(spark, "csv-test")
    df = spark.createDataFrame([(1, " lead"), (2, "trail "), (0, "a  b")], "label INT, text STRING")
    sink_files.write_csv(df, path)
    back = src_files.read_examples_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_labelled_csv_scan_keeps_first_row(spark):
    path = scratch_path(spark, "labelled-csv")
    raw = schema.labelled_raw(spark, SF_SMALL)
    sink_files.write_csv(raw, path, header=False)
    back = src_files.read_labelled_csv(spark, path)
    assert back.columns == schema.LABELLED_COLUMNS
    assert back.count() == raw.count()
    assert sorted(back.toDF(*raw.columns).collect(), key=lambda r: r._c1) == sorted(raw.collect(), key=lambda r: r._c1)
    foreign = spark.createDataFrame([("0,1,d,q,u,a\\nb\\\\c",)], "value STRING")
    foreign.write.text(other := scratch_path(spark, "foreign-csv"))
    assert src_files.read_labelled_csv(spark, other).first().tweet == "a\\nb\\\\c"  # backslashes of others stay


def test_insert_if_absent_and_lookup_prunes_buckets(spark):
    path = scratch_path(spark, "docs-test")
    a = spark.createDataFrame([("k1", "one"), ("k2", "two")], "_id STRING, text STRING")
    keyed.insert_if_absent(spark, a, path)
    b = spark.createDataFrame([("k2", "dup"), ("k3", "three"), ("k3", "three")], "_id STRING, text STRING")
    keyed.insert_if_absent(spark, b, path)
    rows = {r._id: r.text for r in spark.read.parquet(path).collect()}
    assert rows == {"k1": "one", "k2": "two", "k3": "three"}
    look = keyed.lookup(spark, path, "k2")
    plan = look._jdf.queryExecution().executedPlan().toString()
    import re

    assert re.search(r"PartitionFilters: \[.*\(_bucket#\d+ = \d+\)", plan), plan
    assert [r.text for r in look.collect()] == ["two"]


def test_function_scorer_uses_arrow_batches_and_sentinel(spark):
    from microblog.operators.sentiment import function_scorer

    df = spark.createDataFrame([(1, "good day"), (2, "   "), (3, "bad bad day"), (4, "")], "id BIGINT, text STRING")
    scorer = function_scorer(lambda s: s.str.count("bad").clip(upper=2))
    got = {r.id: r.sentiment for r in scorer(df).collect()}
    assert got == {1: 0, 2: -1, 3: 2, 4: -1}


def test_cluster_settings_scale_with_input():
    from microblog.config import cluster_settings

    big = cluster_settings(100 * 10**12, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) % 8000 == 0
    assert int(big["spark.sql.shuffle.partitions"]) * (256 << 20) >= 100 * 10**12
    small = cluster_settings(10**9, 8)
    assert small["spark.sql.shuffle.partitions"] == "8"


def test_strict_parse_fails_on_bad_json(spark):
    import pytest as _pytest

    ok = spark.createDataFrame([('{"id_str":"1","text":"a"}',)], "value STRING")
    assert ok.select(J.parse_strict("value", J.ID_TEXT_DDL).alias("m")).first().m.text == "a"
    bad = spark.createDataFrame([("not json",)], "value STRING")
    with _pytest.raises(Exception):
        bad.select(J.parse_strict("value", J.ID_TEXT_DDL)).collect()


def test_kafka_batch_read_options_start_at_earliest(monkeypatch):
    captured = {}

    class Reader:
        def format(self, f):
            captured["format"] = f
            return self

        def options(self, **o):
            captured.update(o)
            return self

        def load(self):
            return "frame"

    class FakeSpark:
        read = Reader()

    assert kafka.read_batch(FakeSpark(), "broker:9092", "t") == "frame"
    assert captured["format"] == "kafka" and captured["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in captured and captured["subscribe"] == "t"
    kafka.read_batch(FakeSpark(), "broker:9092", "t", starting_offsets='{"t":{"0":5}}')
    assert captured["startingOffsets"] == '{"t":{"0":5}}'


def test_csv_keeps_quotes_commas_backslashes_and_line_ends(spark, tmp_path):
    import pandas as pd

    texts = ['He said ""hi, there"" ok', 'a "quoted, part"', "back\\slash \\n", "one\ntwo\r\nthree", "tail\\"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "label INT, text STRING")
    path = scratch_path(spark, "csv-hard")
    sink_files.write_csv(df, path)
    assert sorted(map(tuple, src_files.read_examples_csv(spark, path).collect())) == sorted(map(tuple, df.collect()))
    f = str(tmp_path / "pandas.csv")
    pd.DataFrame([(0, i, "d", "q", "u", t) for i, t in enumerate(texts)]).to_csv(f, header=False, index=False)
    back = src_files.read_labelled_csv(spark, f, multiline=True)
    assert {r.id: r.tweet for r in back.collect()} == dict(enumerate(t.replace("\r\n", "\n") for t in texts)) or {
        r.id: r.tweet for r in back.collect()} == dict(enumerate(texts))


def test_missing_nested_fields_are_dead_letters(spark):
    rows = [('{"id_str":"1","text":"a","user":{}}',), ('{"id_str":"1","text":"a","user":{"verified":true,"followers_count":1,"friends_count":2}}',)]
    got = [r.reason for r in J.route(spark.createDataFrame(rows, "value STRING"), "value").collect()]
    assert got == ["missing_field", "ok"]


def test_insert_if_absent_keeps_the_smallest_of_equal_keys(spark):
    path = scratch_path(spark, "docs-ties")
    keyed.insert_if_absent(spark, spark.createDataFrame([("k", "b"), ("k", "a")], "_id STRING, text STRING"), path)
    assert [r.text for r in keyed.read(spark, path).collect()] == ["a"]
    late = spark.createDataFrame([("n", "b", 1), ("n", "a", 2), ("k", "c", 0)], "_id STRING, text STRING, at INT")
    keyed.insert_if_absent(spark, late, path, order="at")  # the first delivered
    assert sorted((r._id, r.text) for r in keyed.read(spark, path).collect()) == [("k", "a"), ("n", "b")]


def test_a_cluster_without_a_shared_folder_is_an_error():
    import pytest as _pytest

    from microblog import config

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with _pytest.raises(RuntimeError):
        config.ensure_checkpoint_dir(Session())
