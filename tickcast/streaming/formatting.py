"""Stateless formatting on the stream.

Each incoming document becomes ONE outgoing message holding a JSON array of
its formatted rows (the reference's topic shape), computed with array
functions inside the row — no aggregation, so no streaming state. The row
semantics equal the batch :func:`format_news` / :func:`format_prices`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickcast.functions.scalar import parse_published, to_double, to_utc
from tickcast.schemas import BAR_FIELDS, META_DATA, META_SYMBOL, TIME_SERIES
from tickcast.sources.documents import parse_news, parse_prices, rejection
from tickcast.streaming.sources import FORMAT_NEWS, FORMAT_PRICES, INGEST_NEWS, INGEST_PRICES


def news_rows_array(doc: Column, ticker: Column) -> Column:
    """All (article, own-ticker mention) rows of one news document as an
    array of row structs: explode → explode → filter, done in place."""
    per_article = F.transform(
        F.coalesce(doc["feed"], F.array()),
        lambda a: F.transform(
            F.filter(F.coalesce(a["ticker_sentiment"], F.array()), lambda m: m["ticker"] == ticker),
            lambda m: F.struct(
                to_utc(parse_published(a["time_published"])).alias("time_published"),
                m["ticker"].alias("ticker"),
                to_double(m["ticker_sentiment_score"]).alias("ticker_sentiment_score"),
                m["ticker_sentiment_label"].alias("ticker_sentiment_label"),
                to_double(m["relevance_score"]).alias("relevance_score"),
                a["overall_sentiment_score"].cast("double").alias("overall_sentiment_score"),
                a["overall_sentiment_label"].alias("overall_sentiment_label"),
            ),
        ),
    )
    return F.flatten(per_article)


def price_rows_array(doc: Column) -> Column:
    """All (symbol, date) rows of one price document as an array."""
    symbol = doc[META_DATA][META_SYMBOL]
    return F.transform(
        F.coalesce(F.map_entries(doc[TIME_SERIES]), F.array()),
        lambda e: F.struct(
            symbol.alias("symbol"),
            to_utc(F.try_to_timestamp(e["key"], F.lit("yyyy-MM-dd"))).alias("date"),
            *[to_double(e["value"][src]).alias(name) for src, name in BAR_FIELDS],
        ),
    )


def rows_message(rows: Column) -> Column:
    """Array of row structs → JSON array of JSON-row texts (NULLs kept)."""
    return F.to_json(F.transform(rows, lambda r: F.to_json(r, {"ignoreNullFields": "false"})))


def route(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """T6 + T7: (news, prices, quarantined) by topic and payload validity.
    A malformed payload, or one without the fields that formatting needs, is
    set aside with its ``reason`` instead of stopping the stream."""
    value = F.col("value")
    why = F.when(F.col("topic") == INGEST_NEWS, rejection(value, "news")).otherwise(rejection(value, "prices"))
    flagged = messages.withColumn("reason", why)
    good = flagged.filter(F.col("reason").isNull()).drop("reason")
    return (
        good.filter(F.col("topic") == INGEST_NEWS),
        good.filter(F.col("topic") == INGEST_PRICES),
        flagged.filter(F.col("reason").isNotNull()),
    )


def format_news_messages(news: DataFrame) -> DataFrame:
    """Ingest news message → format_news_topic message (key = ticker, the
    document's own or else the message's key)."""
    doc = news.select(parse_news("value").alias("d"), "key", "offset", "timestamp")
    ticker = F.coalesce(F.col("d.ticker"), F.col("key"))
    rows = news_rows_array(F.col("d"), ticker)
    return doc.select(
        ticker.alias("key"),
        rows_message(rows).alias("value"),
        F.lit(FORMAT_NEWS).alias("topic"),
        F.col("offset"),
        F.col("timestamp"),
    )


def format_price_messages(prices: DataFrame) -> DataFrame:
    """Ingest prices message → format_prices_topic message (key = symbol)."""
    doc = prices.select(parse_prices("value").alias("d"), "offset", "timestamp")
    return doc.select(
        F.col("d")[META_DATA][META_SYMBOL].alias("key"),
        rows_message(price_rows_array(F.col("d"))).alias("value"),
        F.lit(FORMAT_PRICES).alias("topic"),
        F.col("offset"),
        F.col("timestamp"),
    )


def format_stream(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both formatting branches of one subscription, plus the quarantine:
    returns (formatted messages of both topics, quarantined messages)."""
    news, prices, bad = route(messages)
    return format_news_messages(news).unionByName(format_price_messages(prices)), bad
