"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory. Every query reads the given tables (or data Spark
derives from them) in full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions import json as J
from ..functions import labels as L
from ..functions import text as T
from ..operators import prep, stats, topics, windows
from ..operators import vocab as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _te(spark: SparkSession, sf: str) -> DataFrame:
    return schema.english(schema.tweets_base(spark, sf))


# ---------------------------------------------------------------- sources / parsing

@query
def tweets_base(spark, sf):
    return schema.tweets_base(spark, sf)


@query
def kafka_envelope_value(spark, sf):
    env = schema.envelope(schema.tweets(spark, sf))
    value = J.as_text("value")
    msg = F.from_json(value, J.MESSAGE_DDL)
    return env.select(msg.getField("id_str").alias("id_str"),
                      F.length(msg.getField("text")).cast("bigint").alias("value_len"))


# A field of the feed's messages that the typed message lacks.
EXTRA_FIELD, EXTRA_DDL = ',"place":{"name":"here"}}', "place STRUCT<name: STRING>"


@query
def kafka_sink_payload(spark, sf):
    """Whole messages that hold a tracked term, as records of the feed; each
    holds a field that no schema here knows."""
    from ..streaming import live

    env = schema.envelope(schema.tweets(spark, sf))
    more = F.concat(F.expr("substring(cast(value as string), 1, length(cast(value as string)) - 1)"), F.lit(EXTRA_FIELD))
    records = live.feed_records(env.withColumn("value", more.cast("binary")))
    back = F.from_json(F.col("value"), f"{J.MESSAGE_DDL}, {EXTRA_DDL}")
    fields = ["verified", "followers_count", "friends_count"]
    return records.select(back.getField("id_str").alias("id_str"), back.getField("text").alias("text"), back.getField("place").getField("name").alias("place"),
                          *[back.getField("user").getField(f).alias(f) for f in fields])


def _parsed(spark, sf, ddl=J.MESSAGE_DDL, required=("id_str", "text", "user")):
    env = schema.envelope(schema.tweets(spark, sf))
    return J.good(J.route(env.select("value"), "value", ddl, required))


@query
def json_extract_message(spark, sf):
    m = _parsed(spark, sf)
    return m.select("id_str", "text", F.col("user.verified").alias("verified"),
                    F.col("user.followers_count").alias("followers_count"),
                    F.col("user.friends_count").alias("friends_count"))


@query
def json_extract_id_text(spark, sf):
    return _parsed(spark, sf, J.ID_TEXT_DDL, ("id_str", "text")).select("id_str", "text")


@query
def user_fields(spark, sf):
    m = _parsed(spark, sf)
    return m.select("id_str", F.col("user.verified").alias("verified"),
                    F.col("user.followers_count").alias("followers_count"))


@query
def dead_letter_split(spark, sf):
    routed = J.route(schema.bad_record_envelope(spark, sf).select("value"))
    return routed.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- filters / tokens

@query
def english_tweets(spark, sf):
    return _te(spark, sf).select("id_str", "sec", "text")


@query
def track_terms(spark, sf):
    return topics.track_terms(schema.tweets_base(spark, sf)).select("id_str")


# Fixed value: words of a benchmark passage that make a tracked phrase.
PHRASE_WORDS = 3


@query
def track_phrases(spark, sf):
    """Posts with all words of a phrase; phrases are the beginnings of the
    benchmark's passages."""
    words = T.ws_tokens("text")
    phrases = schema.table(spark, sf, "benchmark").select(F.array_join(F.slice(words, 1, PHRASE_WORDS), " ").alias("phrase"))
    posts = schema.tweets_base(spark, sf)
    return topics.track_phrases(posts, topics.phrase_index(phrases, posts)).select("id_str", "phrase")


@query
def token_explode(spark, sf):
    return topics.counts(topics.token_rows(_te(spark, sf)))


@query
def tokens_ws(spark, sf):
    return schema.tweets_base(spark, sf).select("id_str", F.size(T.ws_tokens("text")).cast("int").alias("n_tokens"))


@query
def hashtag_tokens(spark, sf):
    return topics.hashtag_rows(_te(spark, sf))


@query
def mention_tokens(spark, sf):
    return topics.mention_rows(_te(spark, sf))


# ---------------------------------------------------------------- counts / ranking

@query
def hashtag_counts(spark, sf):
    return topics.counts(topics.hashtag_rows(_te(spark, sf)))


@query
def mention_counts(spark, sf):
    return topics.counts(topics.mention_rows(_te(spark, sf)))


@query
def verified_counts(spark, sf):
    return topics.counts(schema.tweets_base(spark, sf), "verified")


@query
def top_hashtags(spark, sf):
    return topics.top_k(topics.counts(topics.hashtag_rows(_te(spark, sf))))


@query
def top_mentions(spark, sf):
    return topics.top_k(topics.counts(topics.mention_rows(_te(spark, sf))))


# ---------------------------------------------------------------- sliding windows

@query
def hashtags_sliding(spark, sf):
    return windows.sliding_count(topics.hashtag_rows(_te(spark, sf), keep=("sec",)), "token")


@query
def mentions_sliding(spark, sf):
    return windows.sliding_count(topics.mention_rows(_te(spark, sf), keep=("sec",)), "token")


@query
def mentions_sliding_all_langs(spark, sf):
    t = schema.tweets_base(spark, sf)
    return windows.sliding_count(topics.mention_rows(t, keep=("sec",)), "token")


@query
def mentions_sliding_additive(spark, sf):
    t = schema.tweets_base(spark, sf)
    return windows.sliding_count(topics.mention_rows(t, keep=("sec",)), "token", inverse="add")


@query
def verified_sliding(spark, sf):
    t = schema.tweets_base(spark, sf).select("verified", "sec")
    return windows.sliding_count(t, "verified", keep_zero=False)


@query
def token_panes(spark, sf):
    return windows.panes(topics.hashtag_rows(_te(spark, sf), keep=("sec",)), "token").withColumnRenamed("c", "n")


# The coarse dense window of the catalogue (1 day every 1 hour).
DENSE_WIDTH = 86_400
DENSE_SLIDE = 3_600


@query
def hashtags_window_dense(spark, sf):
    rows = topics.hashtag_rows(_te(spark, sf), keep=("sec",))
    return windows.dense_sliding_count(rows, "token", DENSE_WIDTH, DENSE_SLIDE)


@query
def top_per_slide(spark, sf):
    rows = topics.mention_rows(_te(spark, sf), keep=("sec",))
    return windows.top_per_window(windows.dense_sliding_count(rows, "token", DENSE_WIDTH, DENSE_SLIDE), "token")


@query
def top_as_of(spark, sf):
    rows = topics.mention_rows(_te(spark, sf), keep=("sec",))
    return windows.top_as_of(rows, "token", DENSE_WIDTH)


# ---------------------------------------------------------------- audience statistics

def _followers(spark, sf):
    return stats.follower_events(schema.table(spark, sf, "events"))


@query
def follower_batch_stats(spark, sf):
    return stats.batch_stats(_followers(spark, sf))


@query
def running_avg_followers(spark, sf):
    return stats.running_average(_followers(spark, sf))


@query
def avg_followers_total(spark, sf):
    return stats.average_total(_followers(spark, sf))


# ---------------------------------------------------------------- text rules

@query
def clean_full(spark, sf):
    return schema.tweets_base(spark, sf).select("id_str", T.clean_full("text").alias("clean"))


@query
def clean_serving(spark, sf):
    return schema.tweets_base(spark, sf).select("id_str", T.clean_serving("text").alias("clean"))


@query
def document_key(spark, sf):
    t = schema.tweets_base(spark, sf).select("id_str", L.document_key("id_str").alias("_id"))
    return t.withColumn("valid", L.valid_document_key("_id"))
