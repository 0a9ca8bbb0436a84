"""Daily sentiment per (symbol, date) — A1-A5 with the F5 labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickcast.functions.scalar import BEARISH, BEARISH_AT, BULLISH, BULLISH_AT, sentiment_label

DAILY_COLUMNS = [
    "symbol",
    "date",
    "positive_news_amount",
    "negative_news_amount",
    "ticker_sentiment_score_mean",
    "ticker_sentiment_score_mean_label",
    "overall_sentiment_score_mean",
    "overall_sentiment_score_mean_label",
]


def sentiment_aggregates() -> list[Column]:
    """A2-A5: counts of the two exact labels, means of the two scores."""
    count = lambda label: F.count_if(F.col("ticker_sentiment_label") == label)
    return [
        count(BULLISH).alias("positive_news_amount"),
        count(BEARISH).alias("negative_news_amount"),
        F.avg("ticker_sentiment_score").alias("ticker_sentiment_score_mean"),
        F.avg("overall_sentiment_score").alias("overall_sentiment_score_mean"),
    ]


def labelled_daily(agg: DataFrame, bullish_at: float = BULLISH_AT, bearish_at: float = BEARISH_AT) -> DataFrame:
    """The daily columns in order, with the F5 label of each mean."""
    for mean in ("ticker_sentiment_score_mean", "overall_sentiment_score_mean"):
        agg = agg.withColumn(f"{mean}_label", sentiment_label(mean, bullish_at, bearish_at))
    return agg.select(*DAILY_COLUMNS)


def daily_sentiment(
    news: DataFrame,
    ticker: str = "ticker",
    bullish_at: float = BULLISH_AT,
    bearish_at: float = BEARISH_AT,
) -> DataFrame:
    """Formatted news → one row per (symbol, UTC day of publication).

    Counts take exactly "Bullish" / "Bearish" mention labels (other labels
    count in neither); means skip NULL scores; a NULL publication time makes
    its own NULL-date group. Partial + final hash aggregation, so a hot
    symbol is combined map-side before the shuffle.
    """
    rows = news.select(
        F.col(ticker).alias("symbol"),
        F.to_date("time_published").alias("date"),
        "ticker_sentiment_label",
        F.col("ticker_sentiment_score").try_cast("double").alias("ticker_sentiment_score"),
        F.col("overall_sentiment_score").try_cast("double").alias("overall_sentiment_score"),
    )
    return labelled_daily(rows.groupBy("symbol", "date").agg(*sentiment_aggregates()), bullish_at, bearish_at)
