"""Hashtags, mentions, tracked terms and ranked counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .common import bind_once, stored

# Terms tracked by the feed in the query catalogue.
TRACK_TERMS = ["error", "click"]


def token_rows(df: DataFrame, prefix: str | None = None, keep: tuple[str, ...] = ("id_str",)) -> DataFrame:
    """One row per space-delimited token (optionally only ``prefix`` tokens);
    the prefix filter runs on the array, before rows are multiplied."""
    toks = T.space_tokens("text")
    if prefix is not None:
        toks = T.prefixed(toks, prefix)
    return df.select(*keep, F.explode(toks).alias("token"))


def hashtag_rows(df: DataFrame, keep: tuple[str, ...] = ("id_str",)) -> DataFrame:
    return token_rows(df, T.HASHTAG_PREFIX, keep)


def mention_rows(df: DataFrame, keep: tuple[str, ...] = ("id_str",)) -> DataFrame:
    return token_rows(df, T.MENTION_PREFIX, keep)


def counts(df: DataFrame, key: str = "token") -> DataFrame:
    """Count per key (partial aggregation map-side, final after the shuffle)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def top_k(counted: DataFrame, key: str = "token", k: int = 10) -> DataFrame:
    """Largest counts first, ties by key; planned as a top-k, not a full sort."""
    return counted.orderBy(F.desc("n"), F.asc(key)).limit(k)


def track_terms(df: DataFrame, terms: list[str] = TRACK_TERMS) -> DataFrame:
    """Posts with any lower-cased, punctuation-stripped token in ``terms``."""
    return df.filter(T.has_any_term("text", terms))


def _distinct_terms(text: str) -> Column:
    """The distinct ``term_tokens`` that are not empty, cleaned in one go."""
    return F.array_distinct(T.ws_tokens(T.strip_punct(F.lower(F.col(text)))))


def phrase_index(phrases: DataFrame, posts: DataFrame | None = None, phrase: str = "phrase", text: str = "text") -> DataFrame:
    """word, words, phrase: each phrase under one of its words (lower-cased,
    punctuation removed). Given ``posts``, that is the word that the fewest of
    their tokens equal, so that a common word of a phrase brings up nothing;
    otherwise the longest. A phrase without words matches nothing."""
    split = phrases.select(phrase).where(F.col(phrase).isNotNull()).distinct().select(phrase, F.array_distinct(F.filter(T.term_tokens(phrase), lambda w: w != "")).alias("words"))
    each = split.select(phrase, "words", F.explode("words").alias("word"))
    if posts is None:
        by = F.struct(-F.length("word"), "word")
    else:
        seen = posts.select(F.explode(T.ws_tokens(T.strip_punct(F.lower(F.col(text))))).alias("word")).join(each.select("word").distinct(), "word", "left_semi")
        seen = seen.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        each = each.join(seen, "word", "left")
        by = F.struct(F.coalesce("n", F.lit(0)), -F.length("word"), "word")
    best = each.groupBy(phrase).agg(F.min_by(F.struct("word", "words"), by).alias("_b"))
    return best.select(F.col("_b.word").alias("word"), F.col("_b.words").alias("words"), F.col(phrase).alias("phrase"))


def track_phrases(posts: DataFrame, index: DataFrame, text: str = "text") -> DataFrame:
    """The posts' columns and ``phrase``, a row for every phrase all of whose
    words occur in the post, in any order (a phrase of one word is a term). The
    index is joined by one word of each phrase, so thousands of phrases cost a
    look-up per distinct token, and only posts with that word are tested.

    Index and posts are written once: the look-up carries a post's number and
    its words, never its text, and the posts meet the phrases it finds by number."""
    numbered = stored(posts.withColumn("_post", F.monotonically_increasing_id()), "numbered-posts")
    asked = numbered.select("_post", F.explode(_distinct_terms(text)).alias("word")).join(stored(index, "phrase-index"), "word")
    found = asked.groupBy("_post").agg(F.collect_list(F.struct("words", "phrase")).alias("_asked"))
    bound = bind_once(numbered.join(found, "_post"), "_words", _distinct_terms(text))
    whole = F.filter("_asked", lambda p: F.forall(p.getField("words"), lambda w: F.array_contains("_words", w)))
    return bound.select(*posts.columns, F.explode(F.transform(whole, lambda p: p.getField("phrase"))).alias("phrase"))
