"""Newest news per ticker on the stream (L1, P15): a bounded list per ticker and
day, kept from micro-batch to micro-batch.

``path/v=<batch>`` holds at most ``n`` rows of every (ticker, UTC day) of the last
``days`` days. A micro-batch merges its own newest rows into the version before
and leaves days out that have passed; the newest ``n`` since the start of any
kept day are among these lists, whatever order the articles came in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.operators.recent import DEFAULT_LIMIT, SALT_BUCKETS, recent_news
from tickcast.sources.snapshots import remove, versions

_DAY = "_day"


def recent_sink(path: str, tiebreak: str, n: int = DEFAULT_LIMIT, days: int = 2, key: str = "ticker") -> Callable[[DataFrame, int], None]:
    """foreachBatch function over news rows; ``tiebreak`` as of
    :func:`~tickcast.operators.recent.recent_news`.

    Kept are the days from ``days - 1`` before the latest one, which a
    publication time in the future does not move past today. Rows of days that
    have passed and rows without a time are in no list. A repeated micro-batch
    reads the version before its own and replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = [v for v in versions(spark, path) if v < batch_id]
        rows = batch.withColumn(_DAY, F.to_date("time_published")).filter(F.col(_DAY).isNotNull())
        if known:
            rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{path}/v={known[-1]}"))
        rows = rows.persist()
        try:
            latest = rows.agg(F.max(F.least(F.col(_DAY), F.current_date())).alias("d")).first().d
            if latest is not None:
                rows_kept = rows.filter(F.col(_DAY) > F.date_sub(F.lit(latest), days))
            else:
                rows_kept = rows
            # the day is part of the group, so one ticker's lists stay n rows a day
            listed = rows_kept.withColumn("_key", F.struct(F.col(key), F.col(_DAY)))
            top = recent_news(listed, n, key="_key", tiebreak=tiebreak, salt_buckets=SALT_BUCKETS).drop("_key", "rank")
            top.select(*rows.columns).write.mode("overwrite").parquet(f"{path}/v={batch_id}")
            for v in known[:-1]:
                remove(spark, f"{path}/v={v}")
        finally:
            rows.unpersist()

    return write


def read_recent(
    spark: SparkSession, path: str, tiebreak: str, n: int = DEFAULT_LIMIT, time_from: str | Column | None = None, key: str = "ticker"
) -> DataFrame:
    """The newest ``n`` rows of each ticker with their ``rank``, as
    :func:`~tickcast.operators.recent.recent_news` over all rows of the stream,
    for a ``time_from`` within the kept days and an ``n`` up to the sink's."""
    known = versions(spark, path)
    if not known:
        raise ValueError(f"no micro-batch has been written to {path}")
    rows = spark.read.parquet(f"{path}/v={known[-1]}").drop(_DAY)
    return recent_news(rows, n, time_from, key, tiebreak=tiebreak)
