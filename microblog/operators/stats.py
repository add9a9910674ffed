"""Audience statistics: per-second count and follower sum, and the running
average since the start (total followers div total posts, integer division,
emitted only for seconds with posts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .indexing import prefix_sum


def follower_events(events: DataFrame) -> DataFrame:
    """sec, followers_count from the raw events table (followers = props.k)."""
    from ..schema import epoch_seconds

    return events.select(
        epoch_seconds(F.col("ts")).alias("sec"),
        F.get_json_object("props", "$.k").cast("int").alias("followers_count"),
    )


def batch_stats(df: DataFrame, sec: str = "sec", followers: str = "followers_count") -> DataFrame:
    """Per 1 s batch: n rows and the follower sum (summed in BIGINT)."""
    return df.groupBy(sec).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(followers).cast("bigint")).alias("total"),
    )


def running_average(df: DataFrame, sec: str = "sec", followers: str = "followers_count") -> DataFrame:
    """sec, total_users, average — cumulative over the ordered 1 s panes.

    Panes are summed first; the global running total then uses the blocked
    prefix sum, so no window runs over the whole table in one task.
    """
    st = batch_stats(df.where(F.col(sec).isNotNull()), sec, followers)
    both = prefix_sum(st, [], sec, ["n", "total"], ["total_users", "total_followers"])
    return both.select(
        sec, "total_users",
        F.expr("total_followers div total_users").cast("bigint").alias("average"),
    )


def average_total(df: DataFrame, followers: str = "followers_count") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.expr(f"sum(cast({followers} as bigint)) div count(1)").cast("bigint").alias("average"),
    )
