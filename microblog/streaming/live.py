"""Streaming versions of the operators (Structured Streaming).

Each builder takes a streaming frame of posts (``schema.TWEET_DDL``) and
returns a streaming frame; ``start_*`` helpers attach sinks. Event time is
``created_at``; callers choose the watermark delay. Sliding windows start from
panes (state per key and pane), so raw rows are never copied once per window:
``timers`` keeps them as keyed state, ``sliding_counts`` chains aggregations.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import json as J
from ..functions import labels as L
from ..functions import text as T
from ..operators import sentiment, softmax, topics, windows
from ..sinks import keyed
from ..sources import kafka
from . import timers

# The reference's micro-batch interval and window.
BATCH_INTERVAL = "1 second"
WINDOW = "300 seconds"
SLIDE = "1 second"


def raw_posts(posts: DataFrame) -> DataFrame:
    """Flat post rows, appended as they arrive."""
    return posts.select("id_str", "sec", "lang", "text",
                        F.col("user.verified").alias("verified"),
                        F.col("user.followers_count").alias("followers_count"),
                        F.col("user.friends_count").alias("friends_count"))


def pane_counts(rows: DataFrame, key: str, delay: str) -> DataFrame:
    """Count per key and 1-second pane (event time), final once the watermark passes."""
    return (rows.withWatermark("created_at", delay)
            .groupBy(F.window("created_at", BATCH_INTERVAL), key)
            .agg(F.count(F.lit(1)).alias("c")))


def sliding_counts(rows: DataFrame, key: str, width: str, slide: str, delay: str) -> DataFrame:
    """key, window_end (epoch seconds), n — chained: panes → sliding windows."""
    p = pane_counts(rows, key, delay)
    w = p.groupBy(F.window(F.window_time("window"), width, slide), key).agg(F.sum("c").alias("n"))
    return w.select(key, F.unix_seconds(F.col("window.end")).alias("window_end"), F.col("n").cast("bigint").alias("n"))


def english_hashtags(posts: DataFrame) -> DataFrame:
    return topics.hashtag_rows(posts.filter(F.col("lang") == "en"), keep=("created_at",))


def english_mentions(posts: DataFrame) -> DataFrame:
    return topics.mention_rows(posts.filter(F.col("lang") == "en"), keep=("created_at",))


def hashtag_windows(posts: DataFrame, width: str = WINDOW, slide: str = SLIDE, delay: str = "10 minutes") -> DataFrame:
    return sliding_counts(english_hashtags(posts), "token", width, slide, delay)


def mention_windows(posts: DataFrame, width: str = WINDOW, slide: str = SLIDE, delay: str = "10 minutes") -> DataFrame:
    return sliding_counts(english_mentions(posts), "token", width, slide, delay)


def top_hashtags_complete(posts: DataFrame, k: int = 10) -> DataFrame:
    """Running counts, sorted and cut to ``k`` (complete output mode)."""
    c = topics.counts(topics.hashtag_rows(posts.filter(F.col("lang") == "en"), keep=()))
    return c.orderBy(F.desc("n"), F.asc("token")).limit(k)


def hashtag_totals(posts: DataFrame) -> DataFrame:
    return topics.counts(topics.hashtag_rows(posts.filter(F.col("lang") == "en"), keep=()))


def follower_average(followers: DataFrame) -> DataFrame:
    """Totals since the start of the stream (complete output mode)."""
    return followers.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.expr("sum(cast(followers_count as bigint)) div count(1)").cast("bigint").alias("average"),
    )


def late_panes(events: DataFrame, delay: str) -> DataFrame:
    """sec, n per 1-second pane; rows whose pane ended before the watermark are dropped."""
    p = (events.withWatermark("created_at", delay)
         .groupBy(F.window("created_at", BATCH_INTERVAL)).agg(F.count(F.lit(1)).alias("n")))
    return p.select(F.unix_seconds(F.col("window.start")).alias("sec"), "n")


def routed_documents(envelopes: DataFrame) -> DataFrame:
    """Kafka-shaped records → documents with a status: ``ok``, the reason why
    the record did not parse, or ``bad_key``. Good rows have ``_id``, the text
    and its serving-clean form."""
    source = [c for c in ("topic", "partition", "offset") if c in envelopes.columns]
    routed = J.route(envelopes.select(*source, "value"), "value", J.ID_TEXT_DDL, ("id_str", "text"))
    key = L.document_key("id_str")
    return routed.select(
        *source, F.col("value").cast("string").alias("value"), key.alias("_id"), "text", T.clean_serving("text").alias("clean"),
        F.when(F.col("reason") != J.REASON_OK, F.col("reason"))
         .when(~L.valid_document_key(key), F.lit("bad_key")).otherwise(F.lit(J.REASON_OK)).alias("status"),
    )


def model_scorer(model: PipelineModel):
    """Documents scored by a Spark ML pipeline."""
    return lambda docs: sentiment.score(model, docs, text="clean")


def vocabulary_scorer(vocab: DataFrame, weights: DataFrame):
    """Documents encoded by the trained vocabulary and scored by its weights."""
    return lambda docs: softmax.score(docs, vocab, weights, id_col="_id", text="clean")


def document_writer(table: str, dead_letters: str, scorer, fold_share: float | None = 0.25):
    """foreachBatch body for ``routed_documents``: the good documents, one of
    each key (the last by offset), are scored by ``scorer`` (adds ``sentiment``;
    reads ``clean``) and upserted; the others are kept as dead letters and never
    reach the model. Both are keyed by batch id, so a replayed batch rewrites
    the same output. Documents are folded into a snapshot once the batches after
    the last one have ``fold_share`` of its bytes (None: never)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch, docs = batch.persist(), None  # written twice: parse the micro-batch once
        try:
            if batch.isEmpty():
                return
            good, last = F.col("status") == J.REASON_OK, F.col("offset") if "offset" in batch.columns else F.lit(0)
            newest = batch.filter(good).repartition("_id").groupBy("_id").agg(F.max(F.struct(last.alias("at"), "text", "clean")).alias("_v"))
            docs = newest.select("_id", "_v.text", "_v.clean").persist()  # scorers read them several times
            keyed.upsert_batch(scorer(docs).select("_id", "text", "sentiment"), table, batch_id)
            kept = [c for c in ("topic", "partition", "offset", "value") if c in batch.columns]
            bad = batch.filter(~good).select(*kept, "_id", "text", "status")
            keyed.upsert_batch(bad, dead_letters, batch_id)
        finally:
            batch.unpersist()
            if docs is not None:
                docs.unpersist()
        if fold_share is not None:
            keyed.fold_if_large(batch.sparkSession, table, fold_share)

    return write


def first_rows_printer(n: int = 10):
    """foreachBatch body: print the first ``n`` rows of each batch."""

    def show(batch: DataFrame, batch_id: int) -> None:
        batch.show(n, truncate=False)

    return show


def tops_printer(key: str, n: int = 10):
    """foreachBatch body for ``timers.salted_tops``: print the ``n`` largest of
    every window that the batch finishes."""

    def show(batch: DataFrame, batch_id: int) -> None:
        for window in windows.top_per_window(batch, key, n).orderBy("window_end", "rank").toLocalIterator():
            print(window.window_end, window["rank"], window[key], window.n)

    return show


def tops_writer(out: str, key: str, n: int = 10):
    """foreachBatch body for ``timers.salted_tops``: the ``n`` largest of every
    window, a folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        keyed.upsert_batch(windows.top_per_window(batch, key, n), out, batch_id)

    return write


def start_dashboards(posts: DataFrame, checkpoint_root: str, interval: str = BATCH_INTERVAL,
                     delay: str = "10 minutes", width: int = windows.WIDTH, slide: int = windows.SLIDE) -> list[StreamingQuery]:
    """Live view every ``interval``: the ten largest hashtags and mentions of
    every finished window and a text preview. A window is shown once the
    watermark (``delay`` behind the newest post) has passed its end; its state is
    one row per key and pane."""
    qs = []
    with timers.state_store(posts.sparkSession):
        for name, frame, show in [
            ("hashtags", timers.salted_tops(english_hashtags(posts), "token", delay, width, slide), tops_printer("token")),
            ("mentions", timers.salted_tops(english_mentions(posts), "token", delay, width, slide), tops_printer("token")),
            ("text", posts.filter(F.col("lang") == "en").select("text"), first_rows_printer(10)),
        ]:
            qs.append(frame.writeStream.outputMode("append").foreachBatch(show)
                      .option("checkpointLocation", f"{checkpoint_root}/{name}")
                      .trigger(processingTime=interval).start())
    return qs


def start_hashtag_change_points(posts: DataFrame, out_dir: str, checkpoint: str,
                                delay: str = "10 seconds", interval: str = BATCH_INTERVAL) -> StreamingQuery:
    """Live 300 s / 1 s hashtag counts in change-point form, as Parquet."""
    with timers.state_store(posts.sparkSession):
        return (timers.change_points(english_hashtags(posts), "token", delay).writeStream.outputMode("append")
                .format("parquet").option("path", out_dir)
                .option("checkpointLocation", checkpoint).trigger(processingTime=interval).start())


def counted_messages(envelopes: DataFrame, name: str = "messages") -> DataFrame:
    """Routed messages (see ``functions.json.route``) whose counts by reason are
    observed while they pass: a field per reason in the query's progress, no
    second pass over the records."""
    routed = J.route(envelopes)
    return routed.observe(name, *[F.count_if(F.col("reason") == r).alias(r) for r in (J.REASON_OK, J.REASON_MISSING, J.REASON_BAD_JSON)])


def observed_totals(progress: list[dict], name: str = "messages") -> dict[str, int]:
    """Sums of the observed counts over all micro-batches of the progress."""
    out: dict[str, int] = {}
    for p in progress:
        seen = p["observedMetrics"].get(name)
        for k, v in (seen.asDict() if seen is not None else {}).items():
            out[k] = out.get(k, 0) + v
    return out


def feed_records(envelopes: DataFrame, terms: list[str] = topics.TRACK_TERMS) -> DataFrame:
    """Records (key, value) of the messages that hold a tracked term, each
    value as it came, with every field it has."""
    posts = J.good(J.route(envelopes.select("value")))
    return kafka.to_records(topics.track_terms(posts, terms))


def start_feed(envelopes: DataFrame, servers: str, topic: str, checkpoint: str, terms: list[str] = topics.TRACK_TERMS) -> StreamingQuery:
    """The producer job: messages → tracked-term filter → Kafka topic."""
    return kafka.start_writer(feed_records(envelopes, terms), servers, checkpoint, topic)
