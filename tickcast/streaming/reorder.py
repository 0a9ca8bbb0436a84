"""Messages of two topics put in the order of their times (S8), ahead of pairing.

A subscription to two topics gives the messages of one symbol in any order
between the topics. :func:`reorder_batches` holds a message back until one that
is ``within`` later has been seen, and then hands it on with all others that are
due, so messages at most ``within`` out of order are paired as in order. What is
held lies in a folder a micro-batch: no state in tasks, and a symbol that owns
most messages is no group of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.sources.snapshots import remove, versions
from tickcast.streaming.sources import FORMAT_NEWS

# Bits of a sequence number below the millisecond: the topic, then the offset.
OFFSET_BITS = 20
# A pairing chunk of such numbers: about a quarter of an hour.
TIME_CHUNK = 1 << (20 + OFFSET_BITS + 1)


def broker_order(news_topic: str = FORMAT_NEWS) -> Column:
    """A sequence number over both topics: the message's time in milliseconds
    (broker times are no finer), at equal times news before prices, then the
    offset. Different for all messages of a symbol, whose messages of a topic
    are in one topic partition, unless 2**20 of them have one millisecond. A
    message without a time comes first."""
    topic = F.when(F.col("topic") == news_topic, F.lit(0)).otherwise(F.lit(1))
    low = F.shiftleft(topic.cast("long"), OFFSET_BITS) + F.col("offset").bitwiseAND((1 << OFFSET_BITS) - 1)
    return F.shiftleft(F.coalesce(F.unix_millis("timestamp"), F.lit(0).cast("long")), OFFSET_BITS + 1) + low


def _latest(spark: SparkSession, path: str):
    return spark.read.parquet(path).agg(F.max("timestamp").alias("t")).first().t


def reorder_batches(buffer: str, sink: Callable[[DataFrame, int], None], within: str = "10 seconds") -> Callable[[DataFrame, int], None]:
    """foreachBatch function over messages: those due go to ``sink``.

    Due are the messages ``within`` or more before the latest time seen, also
    those that come after their time has been passed (the sink takes them as
    late), and those without a time. The others are written to
    ``buffer/held/v=<batch>`` and are looked at again with the next micro-batch.
    The sink gets ``2 * batch`` as its number; :func:`flush` uses the odd ones.
    A repeated micro-batch reads what the one before held, so it hands on the
    same messages under the same number."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, held = batch.sparkSession, f"{buffer}/held"
        known = [v for v in versions(spark, held) if v < batch_id]
        rows, latest = batch, None
        if known:
            latest = _latest(spark, f"{held}/v={known[-1]}")
            if known[-1] not in versions(spark, f"{buffer}/flushed"):
                rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{held}/v={known[-1]}"))
        rows = rows.persist()
        try:
            own = rows.agg(F.max("timestamp").alias("t")).first().t
            latest = max((t for t in (latest, own) if t is not None), default=None)
            wait = F.lit(False) if latest is None else F.coalesce(F.col("timestamp") > F.lit(latest) - F.expr(f"INTERVAL {within}"), F.lit(False))
            rows.filter(wait).write.mode("overwrite").parquet(f"{held}/v={batch_id}")
            sink(rows.filter(~wait), 2 * batch_id)
            for v in known[:-1]:  # the last one is kept for a repetition
                remove(spark, f"{held}/v={v}")
                remove(spark, f"{buffer}/flushed/v={v}")
        finally:
            rows.unpersist()

    return write


def flush(spark: SparkSession, buffer: str, sink: Callable[[DataFrame, int], None]) -> bool:
    """Hand on what is still held, where no later message is waited for: at the
    end of a log, or when a stopped stream has been idle. Call it while the
    stream is not running. The stream goes on afterwards; doing it twice has no
    effect. Returns whether there was something to do."""
    known = versions(spark, f"{buffer}/held")
    if not known or known[-1] in versions(spark, f"{buffer}/flushed"):
        return False
    last = known[-1]
    sink(spark.read.parquet(f"{buffer}/held/v={last}"), 2 * last + 1)
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{buffer}/flushed/v={last}")
    return True
