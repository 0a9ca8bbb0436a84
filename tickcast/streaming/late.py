"""Daily sentiment on the stream with late articles kept apart.

Spark drops rows behind its watermark. Here each micro-batch writes mergeable
partial sums of its rows per (symbol, UTC day), and the rows of days that its
watermark has closed go to a table of late articles instead. The watermark of a
micro-batch is the latest publication time of all earlier ones less the delay,
kept as one row per micro-batch, so a repeated micro-batch decides alike and
replaces its output. No state is held between micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickcast.functions.scalar import BEARISH, BULLISH
from tickcast.operators.sentiment import labelled_daily
from tickcast.schemas import NEWS
from tickcast.sources.sinks import write_batch
from tickcast.sources.snapshots import folder

_MEANS = ("ticker_sentiment_score", "overall_sentiment_score")
PARTIALS = (
    "symbol string, date date, articles long, positive_news_amount long, negative_news_amount long, "
    + ", ".join(f"{m}_sum double, {m}_n long" for m in _MEANS)
    + ", _batch long"
)
MARKS = "latest timestamp, _batch long"


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    fs, p = folder(spark, path)
    fs.mkdirs(p)
    return spark.read.schema(schema).parquet(path)


def partial_daily(news: DataFrame) -> DataFrame:
    """Counts and sums per (symbol, UTC day) that add up over micro-batches; a
    NULL publication time is a day of its own."""
    count = lambda label: F.count_if(F.col("ticker_sentiment_label") == label)
    sums = []
    for m in _MEANS:
        score = F.col(m).try_cast("double")
        sums += [F.sum(score).alias(f"{m}_sum"), F.count(score).alias(f"{m}_n")]
    counts = [F.count(F.lit(1)).alias("articles"), count(BULLISH).alias("positive_news_amount"), count(BEARISH).alias("negative_news_amount")]
    return news.groupBy(F.col("ticker").alias("symbol"), F.to_date("time_published").alias("date")).agg(*counts, *sums)


def daily_of(partials: DataFrame) -> DataFrame:
    """Partial sums of any number of micro-batches → daily sentiment rows."""
    total = partials.groupBy("symbol", "date").agg(
        F.sum("positive_news_amount").alias("positive_news_amount"),
        F.sum("negative_news_amount").alias("negative_news_amount"),
        *[F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_n")).alias(f"{m}_mean") for m in _MEANS],
    )
    return labelled_daily(total)


def late_sink(path: str, delay: str = "1 day"):
    """foreachBatch function over formatted news rows (the ``NEWS`` columns).

    ``path/daily``: partial sums of the rows in time (and of those without a
    time); ``path/late``: the rows whose day was closed, as they came;
    ``path/marks``: the latest publication time of each micro-batch. A day is
    closed when it ends at or before the watermark, as for Spark's windows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = _read(spark, f"{path}/marks", MARKS).filter(F.col("_batch") < batch_id)
        latest = marks.agg(F.max("latest").alias("latest")).first().latest
        rows = batch.persist()
        try:
            day_end = F.date_add(F.to_date("time_published"), 1).cast("timestamp")
            late = F.lit(False) if latest is None else F.coalesce(day_end <= F.lit(latest) - F.expr(f"INTERVAL {delay}"), F.lit(False))
            write_batch(partial_daily(rows.filter(~late)), f"{path}/daily", batch_id)
            write_batch(rows.filter(late), f"{path}/late", batch_id)
            write_batch(rows.agg(F.max("time_published").alias("latest")), f"{path}/marks", batch_id)
        finally:
            rows.unpersist()

    return write


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, f"{path}/daily", PARTIALS).drop("_batch")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The late articles, with the micro-batch that brought them (``_batch``)."""
    return _read(spark, f"{path}/late", T.StructType([*NEWS.fields, T.StructField("_batch", T.LongType())]))


def read_daily(spark: SparkSession, path: str, with_late: bool = False) -> DataFrame:
    """Daily sentiment of the articles in time; ``with_late`` adds the late
    ones, which gives the batch result over all articles."""
    parts = read_partials(spark, path)
    if with_late:
        parts = parts.unionByName(partial_daily(read_late(spark, path).drop("_batch")))
    return daily_of(parts)
