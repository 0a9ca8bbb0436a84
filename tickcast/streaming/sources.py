"""Topic source and message files.

A topic message is (key, value, topic, offset, timestamp). With Kafka on the
class path the source is a Kafka subscription to several topics from the
earliest offset; without it (tests, replays) the same columns come from a
folder of JSON message files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.schemas import MESSAGE

# Topic names of the pipeline.
INGEST_NEWS = "ingest_news_topic"
INGEST_PRICES = "ingest_prices_topic"
FORMAT_NEWS = "format_news_topic"
FORMAT_PRICES = "format_prices_topic"
COMBINED = "combine_data_topic"


# A micro-batch takes at most this many messages of a topic, or message files,
# the first one over a long log too.
MAX_OFFSETS = 1_000_000
MAX_FILES = 1000


def topic_stream(
    spark: SparkSession,
    topics: list[str],
    path: str | None = None,
    bootstrap_servers: str | None = None,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """One streaming frame over several topics. ``max_per_trigger`` bounds a
    micro-batch in messages (topics) or files; default MAX_OFFSETS, MAX_FILES."""
    if bootstrap_servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", starting_offsets)
        )
        reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger or MAX_OFFSETS))
        raw = reader.load()
        return raw.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic",
            "offset",
            "timestamp",
        )
    if path is None:
        raise ValueError("topic_stream needs bootstrap_servers or a message folder path")
    reader = spark.readStream.schema(MESSAGE).option("recursiveFileLookup", "true")
    reader = reader.option("maxFilesPerTrigger", str(max_per_trigger or MAX_FILES))
    return reader.json(path).filter(F.col("topic").isin(topics))


def write_message_files(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Replay helper: messages (any frame with the MESSAGE columns) as JSON
    message files that :func:`topic_stream` reads."""
    cols = [f.name for f in MESSAGE.fields]
    messages.select(*cols).write.mode(mode).json(path)


def as_messages(df: DataFrame, topic: str, key: str, value: str, offset: str, timestamp: str | None = None) -> DataFrame:
    """Frame → MESSAGE columns for one topic."""
    ts = F.col(timestamp).cast("timestamp") if timestamp else F.current_timestamp()
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.col(value).alias("value"),
        F.lit(topic).alias("topic"),
        F.col(offset).cast("long").alias("offset"),
        ts.alias("timestamp"),
    )


def write_topic(messages: DataFrame, topic: str, bootstrap_servers: str) -> None:
    """S9 batch sink: (key, value) messages to a topic with Spark's Kafka
    writer (needs the Kafka connector on the class path)."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save()
    )


def start_topic_sink(messages: DataFrame, topic: str, bootstrap_servers: str, checkpoint: str, trigger: dict | None = None):
    """S9 streaming sink: a streaming frame of (key, value) messages to a
    topic, with its checkpoint on shared storage."""
    writer = (
        messages.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
