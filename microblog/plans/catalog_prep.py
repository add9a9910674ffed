"""Catalogue part 2: corpus preparation, vocabulary, batches, scores, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schema
from ..config import scratch_path
from ..functions import json as J
from ..functions import labels as L
from ..functions import text as T
from ..operators import prep
from ..operators.common import bind_once
from ..operators import vocab as V
from ..sinks import files as sink_files
from ..sinks import keyed
from ..sources import files as src_files
from .catalog import query


@query
def rename_drop(spark, sf):
    raw = prep.rename_columns(schema.labelled_raw(spark, sf), schema.LABELLED_COLUMNS)
    return prep.drop_columns(raw, prep.DROPPED)


@query
def label_remap(spark, sf):
    return schema.labelled(spark, sf).select("id", L.label_remap("sentiment").alias("label"))


def _cleaned_with_edges(spark, sf):
    lab = schema.labelled(spark, sf).select("id", "tweet")
    rows = lab.unionByName(schema.edge_rows(spark))
    return bind_once(rows, "tweet", T.clean_full("tweet"))


@query
def drop_missing(spark, sf):
    return prep.drop_missing(_cleaned_with_edges(spark, sf), ["tweet"])


@query
def drop_blank(spark, sf):
    return prep.drop_blank(prep.drop_missing(_cleaned_with_edges(spark, sf), ["tweet"]), "tweet")


@query
def prepared_examples(spark, sf):
    return prep.first_prepared(spark, sf).select("id", "label", F.col("text").alias("tweet"))


# Fixed value: rows of a head that is shorter than every test corpus.
HEAD_EXAMPLES = 100


@query
def prepared_head(spark, sf):
    return prep.first_prepared(spark, sf, (HEAD_EXAMPLES,)).select("id", "label", F.col("text").alias("tweet"))


@query
def preview(spark, sf):
    """Five rows of the corpus as they are looked at between the steps."""
    return prep.preview(schema.labelled(spark, sf).select("id", "sentiment", "tweet"), key="id").drop("id")


@query
def prep_pipeline(spark, sf):
    return prep.prepared(spark, sf).select("id", "label", F.col("text").alias("tweet"), "pos")


@query
def head_n(spark, sf):
    return prep.head_n(schema.labelled(spark, sf).select("id", "tweet"), 100, "id")


@query
def split_70_30(spark, sf):
    return schema.labelled(spark, sf).select("id", prep.is_train("id").alias("is_train"))


# Fixed value: added to the small ids of the tables, it makes them as long as
# those of real posts.
LONG_ID = 1_312_534_567_590_000_000


@query
def split_70_30_long_ids(spark, sf):
    ids = schema.labelled(spark, sf).select((F.col("id") + F.lit(LONG_ID)).alias("id"))
    return ids.select("id", prep.is_train("id").alias("is_train"))


@query
def shuffle_rows(spark, sf):
    return prep.shuffled_positions(schema.labelled(spark, sf).select("id", "tweet"), "id")


@query
def labelled_csv_scan(spark, sf):
    """The raw corpus, texts as they are, through CSV files."""
    path = scratch_path(spark, "labelled-csv")
    sink_files.write_csv(schema.labelled(spark, sf), path, header=False)
    return src_files.read_labelled_csv(spark, path)


@query
def dead_letter_rows(spark, sf):
    """What does not parse, with all that is needed to replay it."""
    env = schema.bad_record_envelope(spark, sf).select("offset", "value")
    return J.dead(J.route(env, "value")).select("offset", F.col("value").cast("string").alias("value"), "reason")


@query
def csv_scan_roundtrip(spark, sf):
    path = scratch_path(spark, "examples-csv")
    sink_files.write_csv(prep.examples(spark, sf).select("label", "text"), path)
    return src_files.read_examples_csv(spark, path)


@query
def examples_csv_raw(spark, sf):
    """Examples with their texts as they are: punctuation, quotes, line ends."""
    path = scratch_path(spark, "examples-raw-csv")
    rows = schema.labelled(spark, sf).select(L.label_remap("sentiment").alias("label"), F.col("tweet").alias("text"))
    sink_files.write_csv(rows, path)
    return src_files.read_examples_csv(spark, path)


@query
def csv_rescan(spark, sf):
    """The scan between two steps: what a CSV file cannot hold is missing."""
    path = scratch_path(spark, "rescan-csv")
    sink_files.write_csv(_cleaned_with_edges(spark, sf), path)
    return src_files.rescan_csv(spark, path, "id BIGINT, tweet STRING").na.drop("any")


def _train(spark, sf):
    return prep.split(prep.examples(spark, sf))[0]


def _stored_examples(spark, sf):
    """The cleaned corpus, joined and cleaned once for all steps of a query."""
    return prep.stored(prep.examples(spark, sf), "examples")


def _vocab(spark, sf):
    return V.build(_train(spark, sf))


@query
def vocab_build(spark, sf):
    return _vocab(spark, sf)


@query
def vocab_size(spark, sf):
    return V.size(V.token_frequencies(_train(spark, sf)))


@query
def label_counts(spark, sf):
    return _train(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query
def vocab_encode(spark, sf):
    ex = _stored_examples(spark, sf)
    e = V.encode(ex, V.build(prep.split(ex)[0]))
    return e.select("id", F.array_join("ids", " ").alias("ids"), "n_tokens")


@query
def vocab_decode(spark, sf):
    ex = _stored_examples(spark, sf)
    vocab = V.build(prep.split(ex)[0])
    return V.decode(V.encode(ex, vocab), vocab)


@query
def vocab_roundtrip(spark, sf):
    path = scratch_path(spark, "vocab-json")
    sink_files.write_vocab(V.with_specials(_vocab(spark, sf)), path)
    return src_files.read_vocab(spark, path)


@query
def encode_1xn(spark, sf):
    t = schema.tweets_base(spark, sf).select(F.col("id_str").alias("id"),
                                             T.clean_serving("text").alias("text"))
    batch = V.encode(t, _vocab(spark, sf)).withColumn("m", V.as_1xn("ids"))
    return batch.select("id", F.size("m").cast("int").alias("n_rows"),
                        F.size(F.element_at("m", 1)).cast("int").alias("n_cols"),
                        F.array_join(F.element_at("m", 1), " ").alias("ids"))


@query
def length_batches(spark, sf):
    return V.batches(V.lengths(_train(spark, sf))).select("id", "batch", "pos")


@query
def pad_batches(spark, sf):
    train = prep.split(_stored_examples(spark, sf))[0]
    enc = V.encode(train, V.build(train))
    p = V.pad(V.batches(V.lengths(train)), enc)
    return p.select("id", F.array_join("padded", " ").alias("padded"), "n_tokens")


@query
def argmax_class(spark, sf):
    return schema.scores(spark, sf).select("id", L.argmax("scores").alias("sentiment"))


@query
def cross_entropy(spark, sf):
    s = schema.scores(spark, sf).withColumn("label", L.label_remap("sentiment"))
    return s.agg(F.round(F.avg(L.cross_entropy("scores", "label")), 6).alias("ce"))


# Fixed value: marker appended to the text of re-delivered documents.
NEW_VERSION = " (v2)"
LATE_VERSION = " (late)"

# Of each batch of versions, the ids it holds are multiples of this.
VERSIONS = [1, 2, 3]


def _documents(spark, sf):
    t = schema.tweets_base(spark, sf)
    return t.select(L.document_key("id_str").alias("_id"), "text", F.col("id_str").cast("bigint").alias("eid"))


@query
def insert_if_absent(spark, sf):
    path = scratch_path(spark, "documents")
    docs = _documents(spark, sf)
    keyed.insert_if_absent(spark, docs.filter(F.col("eid") % 2 == 0).select("_id", "text"), path)
    again = docs.select("_id", F.concat("text", F.lit(NEW_VERSION)).alias("text"), F.lit(1).alias("delivery"))
    late = docs.select("_id", F.concat("text", F.lit(LATE_VERSION)).alias("text"), F.lit(2).alias("delivery"))
    keyed.insert_if_absent(spark, late.unionByName(again), path, order="delivery")  # the first delivered stays
    return keyed.read(spark, path).select("_id", "text")


@query
def document_table_fold(spark, sf):
    """Three batches of versions; the first two are folded into a snapshot."""
    path = scratch_path(spark, "versions")
    docs = _documents(spark, sf)
    for batch, every in enumerate(VERSIONS):
        rows = docs.filter(F.col("eid") % every == 0)
        text = F.concat("text", F.lit(f" (v{batch + 1})")) if batch else F.col("text")
        keyed.upsert_batch(rows.select("_id", text.alias("text")), path, batch)
        if batch == 1:
            keyed.fold(spark, path)
    return keyed.latest(spark, path)


# Fixed value: the event looked up by key.
LOOKUP_EVENT = 7


@query
def point_lookup(spark, sf):
    path = scratch_path(spark, "documents")
    keyed.insert_if_absent(spark, _documents(spark, sf).select("_id", "text"), path)
    key = str(LOOKUP_EVENT).rjust(19, "0") + L.DOC_KEY_SUFFIX
    return keyed.lookup(spark, path, key)
