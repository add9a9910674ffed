"""Canonical schemas and the derivation of every input from the given tables.

The analysed posts (``tweets``) and the labelled corpus (``labelled``) are
derived with Spark from the ``events``, ``documents`` and ``labels`` tables, so
every query's work grows with those tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.json import MESSAGE_DDL

TWEET_DDL = (
    "id_str STRING, created_at TIMESTAMP, sec BIGINT, lang STRING, text STRING, "
    "user STRUCT<verified: BOOLEAN, followers_count: INT, friends_count: INT>"
)
LABELLED_COLUMNS = ["sentiment", "id", "date", "query", "user", "tweet"]
LABELLED_DDL = "sentiment INT, id BIGINT, date STRING, query STRING, user STRING, tweet STRING"
EXAMPLE_DDL = "label INT, text STRING"
ENVELOPE_DDL = ("key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
                "timestamp TIMESTAMP, timestampType INT")

# Topic name in the envelopes that are built from the tables.
TOPIC = "posts"

# Constants filling the labelled corpus columns that are dropped.
LABELLED_DATE = "Mon Apr 06 22:19:45 PDT 2009"
LABELLED_QUERY = "NO_QUERY"
LABELLED_USER = "corpus"


# The key each text-heavy table is spread by when its files
# give fewer scan splits than the cluster has cores.
SPREAD_KEYS = {"documents": "doc_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    key = SPREAD_KEYS.get(name)
    return spread(df, key) if key else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a scan by ``key`` only when it has fewer splits than the
    cluster has cores (files written as one huge row group scan in one
    task). On a large input this is a no-op; when it applies, a later join or
    aggregation on ``key`` reuses the partitioning."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism  # cores of the cluster
        splits = df.rdd.getNumPartitions()
    except Exception:  # no RDD access (remote session): leave the scan as is
        return df
    return df.repartition(target, F.col(key)) if splits < target else df


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ (no session time zone)."""
    return F.timestamp_diff("SECOND", _epoch_ntz(), ts)


def event_time(ts: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC, whatever the session time zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts))


def _tweet_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events ⋈ documents on id: a shuffle join on both sides at scale."""
    ev = table(spark, sf_dir, "events")
    docs = table(spark, sf_dir, "documents")
    j = ev.join(docs, ev["event_id"] == docs["doc_id"])
    uid = F.col("user_id").cast("string")
    eid = F.col("event_id").cast("string")
    text = F.concat(
        F.lit("@user"), uid, F.lit(" #"), F.col("event_type"),
        F.lit(" http://t.co/"), eid, F.lit(" "), F.col("text"),
    )
    return j.select(
        F.col("event_id"),
        F.lpad(eid, 19, "0").alias("id_str"),
        event_time(F.col("ts")).alias("created_at"),
        epoch_seconds(F.col("ts")).alias("sec"),
        F.col("lang"),
        text.alias("text"),
        (F.col("user_id") % 10 == 0).alias("verified"),
        F.get_json_object("props", "$.k").cast("int").alias("followers_count"),
        (F.col("user_id") % 50).cast("int").alias("friends_count"),
    )


def tweets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat post rows: id_str, sec, lang, text, verified, followers_count, friends_count."""
    return _tweet_join(spark, sf_dir).select(
        "id_str", "sec", "lang", "text", "verified", "followers_count", "friends_count"
    )


def tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical nested post rows (``TWEET_DDL``)."""
    return _tweet_join(spark, sf_dir).select(
        "id_str", "created_at", "sec", "lang", "text",
        F.struct("verified", "followers_count", "friends_count").alias("user"),
    )


def english(df: DataFrame) -> DataFrame:
    return df.filter(F.col("lang") == "en")


def message_json(df: DataFrame) -> Column:
    """The JSON payload of a post: id_str, text and the nested user."""
    user = F.col("user") if "user" in df.columns else F.struct("verified", "followers_count", "friends_count")
    return F.to_json(F.struct(F.col("id_str"), F.col("text"), user.alias("user")))


def envelope(df: DataFrame, offset: Column | None = None) -> DataFrame:
    """Kafka records (null key, JSON value) for a frame of posts."""
    off = offset if offset is not None else F.col("id_str").cast("bigint")
    ts = F.col("created_at") if "created_at" in df.columns else F.timestamp_seconds(F.col("sec"))
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        message_json(df).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        off.alias("offset"),
        ts.alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def bad_record_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope with bad records: id%10=0 lacks ``text``, id%10=1 is not JSON."""
    t = _tweet_join(spark, sf_dir)
    full = F.to_json(F.struct("id_str", "text", F.struct("verified", "followers_count", "friends_count").alias("user")))
    no_text = F.to_json(F.struct("id_str", F.struct("verified", "followers_count", "friends_count").alias("user")))
    value = (F.when(F.col("event_id") % 10 == 0, no_text)
             .when(F.col("event_id") % 10 == 1, F.lit("not json"))
             .otherwise(full))
    return t.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("created_at").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def raw_sentiment(quality: Column, toxic: Column) -> Column:
    """Raw corpus label {0,2,4} from the two binary labels."""
    return (F.when((quality == 1) & (toxic == 0), 4).when(quality == 1, 2).otherwise(0)).cast("int")


def labelled_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six unnamed columns in corpus order, as a header-less CSV scan gives them."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    j = docs.join(labels, "doc_id")
    return j.select(
        raw_sentiment(F.col("quality"), F.col("toxic")).alias("_c0"),
        F.col("doc_id").alias("_c1"),
        F.lit(LABELLED_DATE).alias("_c2"),
        F.lit(LABELLED_QUERY).alias("_c3"),
        F.lit(LABELLED_USER).alias("_c4"),
        F.col("text").alias("_c5"),
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_raw(spark, sf_dir).toDF(*LABELLED_COLUMNS)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed class scores per labelled document: [quality, toxic, 0.5]."""
    labels = table(spark, sf_dir, "labels")
    return labels.select(
        F.col("doc_id").alias("id"),
        F.array(F.col("quality").cast("double"), F.col("toxic").cast("double"), F.lit(0.5)).alias("scores"),
        raw_sentiment(F.col("quality"), F.col("toxic")).alias("sentiment"),
    )


# Hand-written edge rows for the text rules (id, text). Ids are
# negative so they never collide with table ids.
EDGE_ROWS = [
    (-1, "@Bob: Loving #Spark! see HTTP://t.co/x now"),
    (-2, "Wow ... great"),
    (-3, "  lead  and   trail  "),
    (-4, "a\tb\nc"),
    (-5, "@only #tags https://x.y"),
    (-6, ""),
    (-7, "   "),
    (-8, "null"),
    (-9, "e-mail me@x.com"),
    (-10, "!@bob hi"),
    (-11, "cafÉ #été d'or"),
    (-12, "httpfoo stays? no"),
    (-13, "... !!!"),
    (-14, "NaN"),
]


def edge_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EDGE_ROWS, "id BIGINT, tweet STRING")


def edge_rows_sql() -> str:
    vals = ", ".join(f"({i}, {sql_str(t)})" for i, t in EDGE_ROWS)
    return f"(SELECT * FROM (VALUES {vals}) AS e(id, tweet))"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


__all__ = [
    "MESSAGE_DDL", "TWEET_DDL", "tweets_base", "tweets", "english", "envelope",
    "bad_record_envelope", "labelled", "labelled_raw", "scores", "edge_rows",
]
