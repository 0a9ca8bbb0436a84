"""Declared schemas of every layer. Nothing in the library infers a schema.

Field names of the raw documents must equal the upstream payloads, so they
are fixed values.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the upstream price document.
META_DATA = "Meta Data"
TIME_SERIES = "Time Series (Daily)"
META_SYMBOL = "2. Symbol"
META_LAST_REFRESHED = "3. Last Refreshed"
META_KEYS = [
    "1. Information",
    "2. Symbol",
    "3. Last Refreshed",
    "4. Output Size",
    "5. Time Zone",
]
# Bar fields of one day in the upstream price document, in
# document order, with the column name each becomes.
BAR_FIELDS = [
    ("1. open", "open"),
    ("2. high", "high"),
    ("3. low", "low"),
    ("4. close", "close"),
    ("5. adjusted close", "adjusted_close"),
    ("6. volume", "volume"),
    ("7. dividend amount", "dividend_amount"),
    ("8. split coefficient", "split_coefficient"),
]

S = T.StringType()
D = T.DoubleType()

TOPIC = T.StructType([T.StructField("relevance_score", S), T.StructField("topic", S)])

MENTION = T.StructType(
    [
        T.StructField("ticker", S),
        T.StructField("relevance_score", S),
        T.StructField("ticker_sentiment_score", S),
        T.StructField("ticker_sentiment_label", S),
    ]
)

ARTICLE = T.StructType(
    [
        T.StructField("title", S),
        T.StructField("url", S),
        T.StructField("time_published", S),
        T.StructField("authors", T.ArrayType(S)),
        T.StructField("summary", S),
        T.StructField("banner_image", S),
        T.StructField("source", S),
        T.StructField("category_within_source", S),
        T.StructField("source_domain", S),
        T.StructField("topics", T.ArrayType(TOPIC)),
        T.StructField("overall_sentiment_score", D),
        T.StructField("overall_sentiment_label", S),
        T.StructField("ticker_sentiment", T.ArrayType(MENTION)),
    ]
)

# One news document per (ticker, fetch); ``ticker`` is added at landing.
RAW_NEWS = T.StructType(
    [
        T.StructField("items", S),
        T.StructField("sentiment_score_definition", S),
        T.StructField("relevance_score_definition", S),
        T.StructField("feed", T.ArrayType(ARTICLE)),
        T.StructField("ticker", S),
    ]
)

BAR_VALUES = T.StructType([T.StructField(src, S) for src, _ in BAR_FIELDS])

# One price document per (symbol, fetch). The daily series is a map keyed by
# the date string, so any number of days reads with one schema.
RAW_PRICES = T.StructType(
    [
        T.StructField(META_DATA, T.MapType(S, S)),
        T.StructField(TIME_SERIES, T.MapType(S, BAR_VALUES)),
    ]
)

NEWS = T.StructType(
    [
        T.StructField("time_published", T.TimestampType()),
        T.StructField("ticker", S),
        T.StructField("ticker_sentiment_score", D),
        T.StructField("ticker_sentiment_label", S),
        T.StructField("relevance_score", D),
        T.StructField("overall_sentiment_score", D),
        T.StructField("overall_sentiment_label", S),
    ]
)

PRICE_MEASURES = [name for _, name in BAR_FIELDS]

PRICES = T.StructType(
    [T.StructField("symbol", S), T.StructField("date", T.TimestampType())]
    + [T.StructField(name, D) for name in PRICE_MEASURES]
)

# Features of the next-close model: not close, not adjusted close.
FEATURES = ["open", "high", "low", "volume", "dividend_amount", "split_coefficient"]

COMBINED_COLUMNS = [
    "symbol",
    "date",
    "close_price",
    "close_price_prediction",
    "positive_news_amount",
    "negative_news_amount",
    "ticker_sentiment_score_mean",
    "ticker_sentiment_score_mean_label",
    "overall_sentiment_score_mean",
    "overall_sentiment_score_mean_label",
    "timestamp",
    "current_price",
]

# Typed index document (P7): counts become int, everything else as combined.
DOCUMENT = T.StructType(
    [
        T.StructField("symbol", S),
        T.StructField("date", T.DateType()),
        T.StructField("close_price", D),
        T.StructField("close_price_prediction", D),
        T.StructField("positive_news_amount", T.IntegerType()),
        T.StructField("negative_news_amount", T.IntegerType()),
        T.StructField("ticker_sentiment_score_mean", D),
        T.StructField("ticker_sentiment_score_mean_label", S),
        T.StructField("overall_sentiment_score_mean", D),
        T.StructField("overall_sentiment_score_mean_label", S),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("current_price", D),
    ]
)

# A topic message as Structured Streaming delivers it.
MESSAGE = T.StructType(
    [
        T.StructField("key", S),
        T.StructField("value", S),
        T.StructField("topic", S),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
