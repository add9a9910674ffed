"""Kafka source and sink.

The source is Spark's ``kafka`` format (needs the spark-sql-kafka package on
the cluster); the value arrives as bytes and is parsed with
``functions.json.route``. The sink writes ``to_records(df)`` with the producer
settings of the feed. Offsets live in the query checkpoint, so a restart
resumes exactly where the last committed batch ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import message_json

# Producer settings of the feed (idempotent, all acks, gzip,
# 20 ms linger, 32 KiB batches, 5 requests in flight, unbounded retries).
PRODUCER_SETTINGS = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.retries": str(2**31 - 1),
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "20",
    "kafka.batch.size": str(32 * 1024),
}


def source_options(servers: str, topic: str, starting_offsets: str = "latest", group_id: str | None = None,
                   max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the source. Every query reads with a consumer group of its
    own and everything there is, and fails when offsets are lost, unless the
    caller names a group or a limit per trigger."""
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if group_id is not None:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER_SETTINGS}


def read_stream(spark: SparkSession, servers: str, topic: str, **kw) -> DataFrame:
    """Raw envelope stream (key, value, topic, partition, offset, timestamp)."""
    return spark.readStream.format("kafka").options(**source_options(servers, topic, **kw)).load()


def read_batch(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest", **kw) -> DataFrame:
    opts = source_options(servers, topic, starting_offsets=starting_offsets, **kw)
    opts.pop("maxOffsetsPerTrigger", None)  # a limit of streams
    return spark.read.format("kafka").options(**opts).load()


def to_records(df: DataFrame) -> DataFrame:
    """Null key and the message: unchanged where ``df`` holds it as ``value``,
    else JSON of id_str, text and user."""
    if "value" in df.columns:
        return df.select(F.lit(None).cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    return df.select(F.lit(None).cast("string").alias("key"), message_json(df).alias("value"))


def write_stream(df: DataFrame, servers: str, checkpoint: str, topic: str):
    return start_writer(to_records(df), servers, checkpoint, topic)


def start_writer(records: DataFrame, servers: str, checkpoint: str, topic: str):
    """Stream records (key, value) to a topic."""
    return (records.writeStream.format("kafka").options(**sink_options(servers, topic))
            .option("checkpointLocation", checkpoint).start())


def write_batch(df: DataFrame, servers: str, topic: str) -> None:
    to_records(df).write.format("kafka").options(**sink_options(servers, topic)).save()
