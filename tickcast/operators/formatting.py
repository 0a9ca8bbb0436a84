"""Raw documents → flat layers (C1 format_news, C2 format_prices).

Both work on any number of documents of any number of symbols at once: the
document's own ticker is a column, so the mention filter is column-to-column
and no value is pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickcast.functions.scalar import parse_published, to_double, to_utc
from tickcast.schemas import BAR_FIELDS, META_DATA, META_SYMBOL, TIME_SERIES


def format_news(
    raw: DataFrame,
    ticker: str | Column = "ticker",
    source_tz: str = "UTC",
    keep: list[str] | None = None,
    article_fields: list[str] | None = None,
) -> DataFrame:
    """Raw news documents → one row per (article, mention of the document's
    own ticker), with the seven ``NEWS`` columns.

    P1 explode the feed (an empty or NULL feed gives no row), P2 explode the
    mentions, P3 flatten, P4 keep mentions of the document ticker, F1/F2
    parse the publication time. The ticker predicate is applied inside the
    mention array before the second explode, so rows for other tickers are
    never generated; the result equals explode-then-filter. ``keep`` carries
    document columns and ``article_fields`` article fields (e.g. ``url``)
    after the seven news columns.
    """
    keep = keep or []
    article_fields = article_fields or []
    doc_ticker = F.col(ticker) if isinstance(ticker, str) else ticker
    articles = raw.select(*keep, doc_ticker.alias("_doc_ticker"), F.explode("feed").alias("a"))
    mentions = articles.select(
        *keep,
        *[F.col(f"a.{f}").alias(f) for f in article_fields],
        F.col("a.time_published").alias("time_published"),
        F.explode(
            F.filter("a.ticker_sentiment", lambda m: m["ticker"] == F.col("_doc_ticker"))
        ).alias("m"),
        F.col("a.overall_sentiment_score").alias("overall_sentiment_score"),
        F.col("a.overall_sentiment_label").alias("overall_sentiment_label"),
    )
    return mentions.select(
        to_utc(parse_published("time_published"), source_tz).alias("time_published"),
        F.col("m.ticker").alias("ticker"),
        to_double("m.ticker_sentiment_score").alias("ticker_sentiment_score"),
        F.col("m.ticker_sentiment_label").alias("ticker_sentiment_label"),
        to_double("m.relevance_score").alias("relevance_score"),
        F.col("overall_sentiment_score").cast("double").alias("overall_sentiment_score"),
        F.col("overall_sentiment_label").alias("overall_sentiment_label"),
        *article_fields,
        *keep,
    )


def latest_articles(
    news: DataFrame, order_col: str, article: str = "url", ticker: str = "ticker", day: str | None = None
) -> DataFrame:
    """Re-delivered articles: hourly fetches return the same article again,
    so each (ticker, article) is taken from the latest document that carries
    it; repeated mentions inside that document still count, as in the
    reference. A window per (ticker, article) — bounded by how often one
    article is fetched. Articles without an identifier are all kept, and
    spread over as many groups as they have rows' hashes. ``day`` names a column
    that is part of an article's identity: then a day's articles depend on the
    rows of that day only."""
    spread = F.when(F.col(article).isNull(), F.xxhash64(*[c for c in news.columns if c != order_col]))
    w = Window.partitionBy(ticker, article, spread, *([day] if day else []))
    return (
        news.withColumn("_latest", F.max(order_col).over(w))
        .filter(F.col(article).isNull() | (F.col(order_col) == F.col("_latest")))
        .drop("_latest")
    )


def format_prices(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw price documents → one row per (symbol, date) with eight doubles.

    P13 symbol from the document's metadata map, F10 explode the date-keyed
    series, F2 date text → timestamp, P5/F8/F9 the eight measures by their
    upstream keys with ``try_cast``. ``keep`` carries extra document columns
    (e.g. a fetch time used to pick the latest document per day).
    """
    keep = keep or []
    days = raw.select(
        *keep,
        F.col(f"`{META_DATA}`")[META_SYMBOL].alias("symbol"),
        F.explode(F.col(f"`{TIME_SERIES}`")).alias("day", "v"),
    )
    return days.select(
        "symbol",
        to_utc(F.try_to_timestamp("day", F.lit("yyyy-MM-dd"))).alias("date"),
        *[to_double(F.col("v")[src]).alias(name) for src, name in BAR_FIELDS],
        *keep,
    )


def latest_bars(prices: DataFrame, order_col: str) -> DataFrame:
    """One row per (symbol, date): the row of the latest document (§ trap 24:
    overlapping documents repeat days, which would make ``lead`` ambiguous).

    An aggregate, not a window, so it combines map-side; ties on
    ``order_col`` resolve to the larger row, deterministically."""
    rest = [c for c in prices.columns if c not in ("symbol", "date", order_col)]
    picked = prices.groupBy("symbol", "date").agg(
        F.max(F.struct(F.col(order_col), *[F.col(c) for c in rest])).alias("_r")
    )
    return picked.select("symbol", "date", *[F.col(f"_r.{c}").alias(c) for c in rest])
