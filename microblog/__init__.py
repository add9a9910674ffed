"""Microblog stream analytics on Spark.

Short-message streams and corpora are read from Kafka or files, parsed with
dead-letter routing, filtered, ranked over sliding event-time windows, cleaned,
encoded against a vocabulary and scored by a Spark ML sentiment model. Every
operator is a DataFrame / Structured Streaming expression; see README.md.
"""

__all__ = ["config", "schema"]
