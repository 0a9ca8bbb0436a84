"""Combine predictions with daily sentiment (C4: J2, J3, J4, P8, P9, F6/F7).

One left join of daily sentiment to the shifted predictions on
``(symbol, date)`` gives both the inner-join rows and the rows the fallback
needs; a window ``max(matched)`` per symbol then decides, per symbol, which
of the two the reference would have written:

* the symbol has at least one matched day → only matched rows (inner join);
* it has none (no prices at all, or no overlapping day) → every daily
  sentiment row with close and prediction 0 (batch fallback, ``fallback``).

So the emptiness test of the reference (a ``count()`` action per ticker) is a
column, and all symbols run in one plan. Quotes join on ``symbol``; the
quote frame has one row per symbol and Spark/AQE choose a broadcast only
when its measured size is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickcast.functions.scalar import processing_time, quote_price
from tickcast.schemas import COMBINED_COLUMNS


def latest_quotes(quotes: DataFrame, order_col: str = "fetched_at", payload: str = "payload", as_of: str | Column | None = None) -> DataFrame:
    """J4 input: (symbol, current_price) from landed quote payloads — the
    newest payload per symbol, price read with the F11 JSON path. With
    ``as_of`` (a replay's processing time) later payloads are left out."""
    if as_of is not None:
        quotes = quotes.filter(F.col(order_col) <= (F.lit(as_of) if isinstance(as_of, str) else as_of).cast(quotes.schema[order_col].dataType))
    return quotes.groupBy("symbol").agg(
        F.max_by(quote_price(payload), F.col(order_col)).alias("current_price")
    )


def quotes_as_of(rows: DataFrame, quotes: DataFrame, at: str, fetched: str = "fetched_at", price: str = "price", chunk: int = 86400) -> DataFrame:
    """J4 on a replay: ``rows`` (symbol, ``at``, ...) with ``current_price``, the
    newest quote of the symbol fetched at ``at`` or before (NULL if none; of
    quotes fetched at one time the highest price).

    Rows and quotes meet by union, not by a range join. A running last value
    runs inside (symbol, ``chunk`` seconds); the last quote before a chunk comes
    from one summary row per symbol and chunk. So no window holds a symbol's
    whole history, and a symbol of many rows is dealt over its chunks."""
    cell = lambda c: F.floor(F.unix_micros(c) / F.lit(chunk * 1_000_000)).alias("_chunk")
    when = lambda c: F.col(c).cast("timestamp")
    have = quotes.select("symbol", when(fetched).alias("_t"), F.col(price).cast("double").alias("_price")).filter("_t is not null and _price is not null")
    have = have.groupBy("symbol", "_t").agg(F.max("_price").alias("_price")).select("*", cell("_t"))
    row = F.struct(*[F.col(c) for c in rows.columns])
    asked = rows.select("symbol", when(at).alias("_t"), F.lit(None).cast("double").alias("_price"), cell(when(at)), row.alias("_row"))
    both = asked.unionByName(have.withColumn("_row", F.lit(None).cast(asked.schema["_row"].dataType)))
    run = Window.partitionBy("symbol", "_chunk").orderBy("_t", F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_inside", F.last("_price", ignorenulls=True).over(run)).filter("_row is not null")
    # what each chunk starts with
    ends = both.groupBy("symbol", "_chunk").agg(F.max_by("_price", F.when(F.col("_price").isNotNull(), F.col("_t"))).alias("_end"))
    before = Window.partitionBy("symbol").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn("_start", F.last("_end", ignorenulls=True).over(before)).select(F.col("symbol").alias("_s"), F.col("_chunk").alias("_c"), "_start")
    same = F.col("symbol").eqNullSafe(F.col("_s")) & F.col("_chunk").eqNullSafe(F.col("_c"))
    out = inside.join(starts, same, "left")
    return out.select("_row.*", F.when(F.col("_t").isNotNull(), F.coalesce("_inside", "_start")).alias("current_price"))


def combine(
    predicted: DataFrame | None,
    daily: DataFrame,
    quotes: DataFrame | None = None,
    processing: str = "millis",
    now: str | None = None,
    fallback: bool = True,
) -> DataFrame:
    """Predicted prices ⋈ daily sentiment → the 12 combined columns.

    ``predicted`` is the output of ``predict_next_close`` (None: no price
    feed yet, every row is a fallback row); ``daily`` of ``daily_sentiment``;
    ``quotes`` is (symbol, current_price) with one row per symbol (as
    :func:`latest_quotes` returns) or None.
    ``processing`` is "millis" (batch) or "timestamp" (streaming); ``now``
    fixes the processing clock.
    """
    if predicted is None:
        rows = daily.select(
            "*",
            F.lit(None).cast("double").alias("close_price"),
            F.lit(None).cast("double").alias("close_price_prediction"),
            F.lit(False).alias("_matched"),
        )
    else:
        p = predicted.select(
            "symbol",
            "date",
            F.col("close").alias("close_price"),
            F.col("prediction").alias("close_price_prediction"),
            F.lit(True).alias("_matched"),
        )
        rows = daily.join(p, ["symbol", "date"], "left").withColumn(
            "_matched", F.coalesce(F.col("_matched"), F.lit(False))
        )
    matched = F.col("_matched")
    if fallback:
        rows = rows.withColumn("_any", F.max(matched).over(Window.partitionBy("symbol")))
        rows = rows.filter(matched | ~F.col("_any"))
        close = F.when(matched, F.col("close_price")).otherwise(F.lit(0.0))
        pred = F.when(matched, F.col("close_price_prediction")).otherwise(F.lit(0.0))
    else:
        rows = rows.filter(matched)
        close, pred = F.col("close_price"), F.col("close_price_prediction")

    out = rows.select(
        "symbol",
        "date",
        close.alias("close_price"),
        pred.alias("close_price_prediction"),
        "positive_news_amount",
        "negative_news_amount",
        "ticker_sentiment_score_mean",
        "ticker_sentiment_score_mean_label",
        "overall_sentiment_score_mean",
        "overall_sentiment_score_mean_label",
        processing_time(processing, now).alias("timestamp"),
    )
    if quotes is None:
        out = out.withColumn("current_price", F.lit(None).cast("double"))
    else:
        out = out.join(quotes.select("symbol", "current_price"), "symbol", "left")
    return out.select(*COMBINED_COLUMNS)


def pair_by_symbol(news: DataFrame, prices: DataFrame, news_key: str = "ticker", price_key: str = "symbol") -> DataFrame:
    """Pair news and price inputs by symbol (the reference pairs two key
    lists by position). Each side is reduced to one row per symbol before
    the join, so no within-symbol pairs are ever formed."""
    n = news.groupBy(F.col(news_key).alias("symbol")).agg(F.count(F.lit(1)).alias("news_rows"))
    p = prices.groupBy(F.col(price_key).alias("symbol")).agg(
        F.count(F.lit(1)).alias("price_rows"),
        F.min("date").alias("first_price_date"),
        F.max("date").alias("last_price_date"),
    )
    return n.join(p, "symbol", "inner")
