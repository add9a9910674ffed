"""Oracles of the streaming replays: the batch query each must equal."""

from __future__ import annotations

from .catalog_stream import LATE_DELAY_MS
from .oracle import ORACLE, oracle

oracle("stream_raw_append", ORACLE["tweets_base"])
oracle("stream_hashtags_sliding", ORACLE["hashtags_window_dense"])
oracle("stream_top_complete", ORACLE["top_hashtags"])
oracle("stream_hashtags_change_points", ORACLE["hashtags_sliding"])
oracle("stream_mentions_change_points", ORACLE["mentions_sliding"])
oracle("stream_mentions_additive_change_points", ORACLE["mentions_sliding_additive"])
oracle("stream_verified_change_points", ORACLE["verified_sliding"])
oracle("stream_top_per_slide", ORACLE["top_per_slide"])
oracle("late_corrections", ORACLE["hashtags_window_dense"])
oracle("stream_message_counts", ORACLE["dead_letter_split"])
oracle("directory_posts", ORACLE["tweets_base"])
oracle("stream_avg_followers", ORACLE["avg_followers_total"])
oracle("stream_restart_equals_single_run", ORACLE["hashtag_counts"])
oracle("late_rows_dropped", f"""
WITH f AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec, epoch_ms(ts) AS ms FROM events),
wm AS (SELECT max(ms) - {LATE_DELAY_MS} AS wm FROM f WHERE event_id % 3 <> 0),
kept AS (SELECT sec FROM f WHERE event_id % 3 <> 0
         UNION ALL SELECT sec FROM f, wm WHERE event_id % 3 = 0 AND (sec + 1) * 1000 > wm.wm)
SELECT sec, count(*) AS n FROM kept GROUP BY sec""")
