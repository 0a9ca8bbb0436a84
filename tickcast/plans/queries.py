"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole test tables, plus the DuckDB SQL that states the same result.

Compared outputs are "reports": doubles are snapped to a fixed grid with the
same floor expression in both engines (aggregates sum in different orders),
timestamps are wall-clock UTC (``timestamp_ntz``) and the processing clock is
fixed, so results are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.functions.scalar import snap
from tickcast.operators.combine import combine, latest_quotes, pair_by_symbol, quotes_as_of
from tickcast.operators.forecast import (
    predict_next_close,
    next_day_close,
    score,
    scoring_rows,
    shift_right_join,
    training_condition,
    update_fit,
    with_next_rows,
    as_of_date,
)
from tickcast.operators.formatting import format_news, format_prices
from tickcast.operators.sentiment import daily_sentiment
from tickcast.plans import oracle as O
from tickcast.schemas import PRICE_MEASURES
from tickcast.session import ensure_session
from tickcast.sources import proxy
from tickcast.functions.scalar import symbol_from_path
from tickcast.operators.pairing import pair_latest_reset
from tickcast.operators.recent import recent_news
from tickcast.session import scratch_path
from tickcast.sources.compaction import compact_documents
from tickcast.sources.documents import (
    news_rows,
    parse_news,
    parse_prices,
    read_raw_news,
    read_raw_prices,
    malformed_documents,
    read_stamps,
)
from tickcast.sources.sinks import land, read_documents, row_batches, write_documents
from tickcast.streaming.formatting import route

# Fixed parameters of the registered queries: the split dates inside each
# proxy's date range and the processing clock (2024-02-01T00:00:00Z).
EV_AS_OF = "2024-01-25"
ORD_AS_OF = "2001-06-30"
NOW = "2024-02-01 00:00:00"
NOW_MILLIS = 1706745600000
STREAM_AS_OF = "2024-01-31"  # the streaming combine splits at "yesterday" of NOW
NOW_EARLIER = "2024-01-31 00:00:00"
NOW_EARLIER_MILLIS = 1706659200000
FALLBACK_SYMBOLS = ["S3"]  # bars removed for these symbols in combine_fallback
RECENT_FROM = "2024-01-20 12:34:56"  # P15 bound: start of this day
RECENT_LIMIT = 200  # L1: the upstream request limit

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ reports
def iso_date(c: str | Column) -> Column:
    """Dates travel as ISO text in reports, so no engine's date mapping
    matters when results are compared."""
    return F.date_format(F.to_date(c), "yyyy-MM-dd")


def iso_time(c: str) -> Column:
    """UTC wall-clock text of a timestamp."""
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def report_news(df: DataFrame) -> DataFrame:
    return df.select(
        iso_time("time_published").alias("time_published"),
        "ticker",
        snap("ticker_sentiment_score", 1e9).alias("ticker_sentiment_score"),
        "ticker_sentiment_label",
        snap("relevance_score", 1e9).alias("relevance_score"),
        snap("overall_sentiment_score", 1e9).alias("overall_sentiment_score"),
        "overall_sentiment_label",
    )


def report_daily(df: DataFrame) -> DataFrame:
    return df.select(
        "symbol",
        iso_date("date").alias("date"),
        "positive_news_amount",
        "negative_news_amount",
        snap("ticker_sentiment_score_mean", 1e9).alias("ticker_sentiment_score_mean"),
        "ticker_sentiment_score_mean_label",
        snap("overall_sentiment_score_mean", 1e9).alias("overall_sentiment_score_mean"),
        "overall_sentiment_score_mean_label",
    )


def report_bars(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    return df.select(
        "symbol",
        iso_date("date").alias("date"),
        *[snap(m).alias(m) for m in PRICE_MEASURES],
        *[snap(c).alias(c) for c in (extra or [])],
    )


def report_combined(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return df.select(
        "symbol",
        iso_date("date").alias("date"),
        snap("close_price").alias("close_price"),
        snap("close_price_prediction").alias("close_price_prediction"),
        "positive_news_amount",
        "negative_news_amount",
        snap("ticker_sentiment_score_mean", 1e9).alias("ticker_sentiment_score_mean"),
        "ticker_sentiment_score_mean_label",
        snap("overall_sentiment_score_mean", 1e9).alias("overall_sentiment_score_mean"),
        "overall_sentiment_score_mean_label",
        "timestamp",
        snap("current_price").alias("current_price"),
        *(keep or []),
    )


# ------------------------------------------------------------------ building blocks
def _combine(spark: SparkSession, bars: DataFrame, news: DataFrame, as_of: str) -> DataFrame:
    # Bars feed the model and the quotes: daily aggregates, persisted once.
    bars = bars.persist(StorageLevel.MEMORY_AND_DISK)
    predicted = predict_next_close(bars, as_of)
    quotes = latest_quotes(proxy.quote_payloads(bars))
    return combine(predicted, daily_sentiment(news), quotes, processing="millis", now=NOW)


def _raw_news_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = proxy.event_news_documents(spark, sf_dir)
    return docs.select(parse_news("value").alias("d")).select("d.*")


def _raw_prices_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = proxy.event_price_documents(spark, sf_dir)
    return docs.select(parse_prices("value").alias("d")).select("d.*")


# ------------------------------------------------------------------ queries
def q_format_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested news documents (JSON text) → rows."""
    return report_news(format_news(_raw_news_from_events(spark, sf_dir)))


def q_format_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date-keyed price documents → rows."""
    return report_bars(format_prices(_raw_prices_from_events(spark, sf_dir)))


def q_batched_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows → JSON-array messages (≤200 articles each) →
    typed rows again."""
    news = proxy.event_news(spark, sf_dir, with_id=True).withColumn(
        "block", F.floor(F.col("event_id") / F.lit(proxy.ITEMS_PER_DOCUMENT))
    )
    cols = [c for c in news.columns if c not in ("event_id", "block")]
    messages = row_batches(news, ["ticker", "block"], cols).withColumnRenamed("ticker", "key")
    return report_news(news_rows(messages))


def q_daily_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts, means and labels per symbol."""
    return report_daily(daily_sentiment(proxy.event_news(spark, sf_dir)))


def q_sentiment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """distribution of the daily label pairs."""
    daily = daily_sentiment(proxy.event_news(spark, sf_dir))
    return daily.groupBy("ticker_sentiment_score_mean_label", "overall_sentiment_score_mean_label").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("positive_news_amount").alias("positive_news_amount"),
        F.sum("negative_news_amount").alias("negative_news_amount"),
    )


def q_next_day_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next row's close per symbol by date."""
    return report_bars(next_day_close(proxy.event_bars(spark, sf_dir)), ["next_day_close"])


def q_train_score_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and scoring flags per bar."""
    lab = with_next_rows(proxy.event_bars(spark, sf_dir))
    return lab.select(
        "symbol",
        iso_date("date").alias("date"),
        training_condition(lab, EV_AS_OF).alias("is_train"),
        (F.col("date") <= as_of_date(EV_AS_OF)).alias("is_score"),
    )


def q_predict_next_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-symbol OLS, scored and moved to the next day."""
    pred = predict_next_close(proxy.event_bars(spark, sf_dir), EV_AS_OF)
    return report_bars(pred, ["next_day_close", "prediction"])


def q_predict_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3, M5: the fit of ``predict_next_close`` from bars that come in three
    batches of days, none of which reads the days before."""
    path = scratch_path(spark, "fit")
    bars = proxy.event_bars(spark, sf_dir)
    days = [None, "2024-01-10", "2024-01-20", None]
    for i, (a, b) in enumerate(zip(days[:-1], days[1:])):
        some = bars.filter(F.col("date") >= F.lit(a).cast("date")) if a else bars
        some = some.filter(F.col("date") < F.lit(b).cast("date")) if b else some
        coefficients = update_fit(spark, path, some, i, EV_AS_OF)
    scored = score(scoring_rows(with_next_rows(bars), EV_AS_OF), coefficients)
    return report_bars(shift_right_join(scored), ["next_day_close", "prediction"])


def q_predict_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1-M5, F4, J1 with one model per supplier: symbols grow with the table.
    Most days have one line, so the features are nearly collinear: predictions
    are reported to the hundredth."""
    pred = predict_next_close(proxy.supplier_bars(spark, sf_dir), ORD_AS_OF)
    return report_bars(pred.withColumn("prediction", snap("prediction", 1e2)), ["next_day_close", "prediction"])


def q_shift_right_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar-day shift + right join, with the day's close as the
    prediction."""
    lab = with_next_rows(proxy.event_bars(spark, sf_dir))
    scored = scoring_rows(lab, EV_AS_OF).withColumn("prediction", F.col("close"))
    out = shift_right_join(scored, "calendar")
    return out.select(
        "symbol", iso_date("date").alias("date"), snap("close").alias("close"),
        snap("next_day_close").alias("next_day_close"), snap("prediction").alias("prediction"),
    )


def q_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole combine on the events proxy."""
    bars = proxy.event_bars(spark, sf_dir)
    return report_combined(_combine(spark, bars, proxy.event_news(spark, sf_dir), EV_AS_OF))


def q_combine_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols without prices get their sentiment rows with
    zero close and prediction."""
    bars = proxy.event_bars(spark, sf_dir).filter(~F.col("symbol").isin(FALLBACK_SYMBOLS))
    return report_combined(_combine(spark, bars, proxy.event_news(spark, sf_dir), EV_AS_OF))


def q_quote_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 input, F11: current price per symbol out of quote payloads."""
    quotes = latest_quotes(proxy.quote_payloads(proxy.event_bars(spark, sf_dir)))
    return quotes.select("symbol", snap("current_price").alias("current_price"))


def q_pair_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News and price inputs paired by symbol."""
    pairs = pair_by_symbol(proxy.event_news(spark, sf_dir), proxy.event_bars(spark, sf_dir))
    return pairs.select(
        "symbol", "news_rows", "price_rows",
        iso_date("first_price_date").alias("first_price_date"),
        iso_date("last_price_date").alias("last_price_date"),
    )


def q_bench_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything on the orders proxy: lineitem ⋈ orders ⋈ customer bars,
    orders ⋈ customer news, OLS, shifted join, fallback, quotes."""
    seg = proxy.segment_orders(spark, sf_dir)
    bars = proxy.order_bars(spark, sf_dir, seg)
    return report_combined(_combine(spark, bars, proxy.order_news(spark, sf_dir, seg), ORD_AS_OF))


def q_recent_news_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 200 articles per symbol since the start of a day."""
    news = proxy.event_news(spark, sf_dir, with_id=True)
    top = recent_news(news, RECENT_LIMIT, RECENT_FROM, key="ticker", tiebreak="event_id")
    return top.select(
        "ticker", "event_id", iso_time("time_published").alias("time_published"), F.col("rank").cast("long").alias("rank")
    )


def q_pair_latest_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6, T3 (batch form): latest news × latest prices message per symbol,
    emitted and reset; empty messages clear their slot."""
    pairs = pair_latest_reset(proxy.event_messages(spark, sf_dir), payload=False)
    return pairs.select("symbol", "seq", "news_seq", "prices_seq")


def q_landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News documents landed by kind and symbol, read
    back by path, ticker taken from the path, formatted."""
    base = scratch_path(spark, "landing")
    land(proxy.event_news_documents(spark, sf_dir), base, "news")
    raw = read_raw_news(spark, f"{base}/kind=news")
    return report_news(format_news(raw, ticker=symbol_from_path("_path")))


def q_ticker_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price documents landed per symbol; ticker
    from the path and from the payload agree, day counts per symbol."""
    base = scratch_path(spark, "landing")
    land(proxy.event_price_documents(spark, sf_dir), base, "prices")
    raw = read_raw_prices(spark, f"{base}/kind=prices")
    rows = format_prices(raw.withColumn("path_symbol", symbol_from_path("_path")), keep=["path_symbol"])
    return rows.groupBy("path_symbol", "symbol").agg(
        F.count(F.lit(1)).alias("days"), iso_date(F.max("date")).alias("last_date")
    )


def q_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combined rows written as typed per-symbol documents
    (append), read back."""
    bars = proxy.event_bars(spark, sf_dir)
    combined = _combine(spark, bars, proxy.event_news(spark, sf_dir), EV_AS_OF)
    path = scratch_path(spark, "documents")
    write_documents(combined, path, mode="append")
    docs = read_documents(spark, path)
    return report_combined(docs, keep=["index"])


def q_upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 upsert: a load before the price feed (all fallback rows), then
    the full load; the newest document per (symbol, date) wins."""
    bars = proxy.event_bars(spark, sf_dir)
    news = proxy.event_news(spark, sf_dir)
    quotes = latest_quotes(proxy.quote_payloads(bars))
    daily = daily_sentiment(news)
    path = scratch_path(spark, "documents")
    first = combine(None, daily, quotes, processing="millis", now=NOW_EARLIER)
    write_documents(first, path, mode="upsert", load_id=1)
    second = combine(predict_next_close(bars, EV_AS_OF), daily, quotes, processing="millis", now=NOW)
    write_documents(second, path, mode="upsert", load_id=2)
    docs = read_documents(spark, path)
    return report_combined(docs, keep=["index"])


def q_compacted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loads of ``upsert_documents``, the full one in three parts by
    date, with a compaction after each load but the last."""
    bars = proxy.event_bars(spark, sf_dir)
    quotes = latest_quotes(proxy.quote_payloads(bars))
    daily = daily_sentiment(proxy.event_news(spark, sf_dir))
    path = scratch_path(spark, "documents")
    first = combine(None, daily, quotes, processing="millis", now=NOW_EARLIER)
    write_documents(first, path, mode="upsert", load_id=1)
    compact_documents(spark, path)
    second = combine(predict_next_close(bars, EV_AS_OF), daily, quotes, processing="millis", now=NOW)
    part = F.coalesce(F.pmod(F.dayofmonth("date"), F.lit(3)), F.lit(0))
    for i in range(3):
        write_documents(second.filter(part == i), path, mode="upsert", load_id=2 + i)
        if i < 2:
            compact_documents(spark, path)
    return report_combined(read_documents(spark, path), keep=["index"])


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 + T7: messages routed as the stream routes them; those set aside are
    counted by reason instead of stopping the consumer."""
    news, prices, bad = route(proxy.mixed_messages(spark, sf_dir))
    good = news.unionByName(prices).withColumn("reason", F.lit("ok"))
    return good.unionByName(bad).groupBy("symbol", "topic", "reason").agg(F.count(F.lit(1)).alias("messages"))


def q_landed_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents that formatting gets no rows from, by
    kind, symbol of the path and reason."""
    base = scratch_path(spark, "landing")
    docs = proxy.mixed_messages(spark, sf_dir)
    found = []
    for kind in ("news", "prices"):
        land(docs.filter(F.col("topic") == f"ingest_{kind}_topic"), base, kind)
        bad = malformed_documents(spark, f"{base}/kind={kind}", kind)
        found.append(bad.select(F.lit(kind).alias("kind"), symbol_from_path("path").alias("symbol"), "reason", "record"))
    both = found[0].unionByName(found[1])
    return both.groupBy("kind", "symbol", "reason").agg(F.count(F.lit(1)).alias("documents"), F.count("record").alias("records"))


def q_landing_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticker and time of ingestion on every landed document."""
    base = scratch_path(spark, "landing")
    land(proxy.mixed_messages(spark, sf_dir), base, "any", ingested_at=NOW)
    stamps = read_stamps(spark, f"{base}/kind=any").filter("ticker is not null")
    return stamps.groupBy("ticker", F.date_format("ingest_ts", "yyyy-MM-dd HH:mm:ss").alias("ingest_ts")).agg(F.count(F.lit(1)).alias("documents"))


def q_quotes_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 on a replay: each article with the price known when it was published."""
    ev = proxy.events(spark, sf_dir).filter("event_type <> 'purchase'").select("symbol", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    return quotes_as_of(ev, proxy.event_quotes(spark, sf_dir), "ts").select("event_id", "symbol", snap("current_price").alias("current_price"))


def _ensured(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ensure_session(spark), sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Query] = {
    "format_news": q_format_news,
    "format_prices": q_format_prices,
    "batched_messages": q_batched_messages,
    "daily_sentiment": q_daily_sentiment,
    "sentiment_labels": q_sentiment_labels,
    "next_day_close": q_next_day_close,
    "train_score_split": q_train_score_split,
    "predict_next_close": q_predict_next_close,
    "predict_incremental": q_predict_incremental,
    "predict_suppliers": q_predict_suppliers,
    "shift_right_join": q_shift_right_join,
    "combine": q_combine,
    "combine_fallback": q_combine_fallback,
    "quote_enrich": q_quote_enrich,
    "pair_by_symbol": q_pair_by_symbol,
    "recent_news_topk": q_recent_news_topk,
    "pair_latest_reset": q_pair_latest_reset,
    "landing_roundtrip": q_landing_roundtrip,
    "ticker_from_path": q_ticker_from_path,
    "documents": q_documents,
    "upsert_documents": q_upsert_documents,
    "compacted_documents": q_compacted_documents,
    "quarantine": q_quarantine,
    "landed_quarantine": q_landed_quarantine,
    "landing_stamps": q_landing_stamps,
    "quotes_as_of": q_quotes_as_of,
    "bench_combine": q_bench_combine,
}


# ------------------------------------------------------------------ oracle SQL
def _oracles() -> dict[str, str]:
    ev_news = O.with_(O.EV, O.EV_NEWS)
    ev_bars = O.with_(O.EV, O.EV_BARS)
    ev_daily = O.with_(O.EV, O.EV_NEWS, O.DAILY)
    fallback_bars = O.EV_BARS.replace(
        "WHERE event_type = 'purchase'",
        "WHERE event_type = 'purchase' AND symbol NOT IN ("
        + ", ".join(f"'{s}'" for s in FALLBACK_SYMBOLS)
        + ")",
    )
    return {
        "format_news": ev_news + O.news_select(),
        "format_prices": ev_bars + O.bars_select(),
        "batched_messages": ev_news + O.news_select(),
        "daily_sentiment": ev_daily + O.daily_select(),
        "sentiment_labels": ev_daily
        + """SELECT ticker_sentiment_score_mean_label, overall_sentiment_score_mean_label,
       count(*) AS days, CAST(sum(positive_news_amount) AS BIGINT) AS positive_news_amount,
       CAST(sum(negative_news_amount) AS BIGINT) AS negative_news_amount
FROM daily_l GROUP BY 1, 2""",
        "next_day_close": ev_bars
        + f""", nx AS (SELECT *, lead(close) OVER (PARTITION BY symbol ORDER BY date) AS next_day_close FROM bars)
{O.bars_select('nx', ', ' + O.snap('next_day_close') + ' AS next_day_close')}""",
        "train_score_split": O.with_(O.EV, O.EV_BARS, O.labelled(EV_AS_OF))
        + f"SELECT symbol, {O.iso_date('date')} AS date, t AS is_train, date <= DATE '{EV_AS_OF}' AS is_score FROM lab",
        "predict_suppliers": O.with_(O.SUPP_BARS, O.predicted(ORD_AS_OF, O.ols_grouped))
        + O.bars_select(
            "pred",
            f", {O.snap('next_day_close')} AS next_day_close, {O.snap('prediction', 1e2)} AS prediction",
        ),
        "predict_next_close": O.with_(O.EV, O.EV_BARS, O.predicted(EV_AS_OF))
        + O.bars_select(
            "pred",
            f", {O.snap('next_day_close')} AS next_day_close, {O.snap('prediction')} AS prediction",
        ),
        "shift_right_join": O.with_(O.EV, O.EV_BARS)
        + f""", nx AS (SELECT *, lead(close) OVER (PARTITION BY symbol ORDER BY date) AS y FROM bars),
s AS (SELECT symbol, date + 1 AS date, close AS prediction FROM bars WHERE date <= DATE '{EV_AS_OF}')
SELECT s.symbol AS symbol, {O.iso_date('s.date')} AS date, {O.snap('nx.close')} AS close,
       {O.snap('nx.y')} AS next_day_close, {O.snap('s.prediction')} AS prediction
FROM nx RIGHT JOIN s ON nx.symbol = s.symbol AND nx.date = s.date""",
        "combine": O.with_(O.EV, O.EV_NEWS, O.DAILY, O.EV_BARS, O.combined(EV_AS_OF, NOW_MILLIS))
        + O.combined_select(),
        "combine_fallback": O.with_(O.EV, O.EV_NEWS, O.DAILY, fallback_bars, O.combined(EV_AS_OF, NOW_MILLIS))
        + O.combined_select(),
        "quote_enrich": ev_bars
        + f"SELECT symbol, {O.snap('arg_max(close, date)')} AS current_price FROM bars GROUP BY symbol",
        "pair_by_symbol": O.with_(O.EV, O.EV_NEWS, O.EV_BARS)
        + """SELECT n.symbol AS symbol, n.news_rows AS news_rows, p.price_rows AS price_rows,
       strftime(p.first_price_date, '%Y-%m-%d') AS first_price_date,
       strftime(p.last_price_date, '%Y-%m-%d') AS last_price_date
FROM (SELECT ticker AS symbol, count(*) AS news_rows FROM news GROUP BY 1) n
JOIN (SELECT symbol, count(*) AS price_rows, min(date) AS first_price_date,
             max(date) AS last_price_date FROM bars GROUP BY 1) p ON n.symbol = p.symbol""",
        "recent_news_topk": ev_news
        + f"""SELECT ticker, event_id, {O.iso_time('time_published')} AS time_published, rank
FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY time_published DESC, event_id) AS rank
      FROM news WHERE time_published >= date_trunc('day', TIMESTAMP '{RECENT_FROM}'))
WHERE rank <= {RECENT_LIMIT}""",
        "pair_latest_reset": O.PAIR_FOLD,
        "landing_roundtrip": ev_news + O.news_select(),
        "ticker_from_path": ev_bars
        + f"""SELECT symbol AS path_symbol, symbol, count(*) AS days, {O.iso_date('max(date)')} AS last_date
FROM bars GROUP BY symbol""",
        "documents": O.with_(O.EV, O.EV_NEWS, O.DAILY, O.EV_BARS, O.combined(EV_AS_OF, NOW_MILLIS))
        + O.documents_select("comb"),
        "upsert_documents": O.with_(O.EV, O.EV_NEWS, O.DAILY, O.EV_BARS, O.combined(EV_AS_OF, NOW_MILLIS))
        + f""", first_load AS (
  SELECT d.symbol, d.date, CAST(0.0 AS DOUBLE) AS close_price, CAST(0.0 AS DOUBLE) AS close_price_prediction,
         d.positive_news_amount, d.negative_news_amount, d.ticker_sentiment_score_mean,
         d.ticker_sentiment_score_mean_label, d.overall_sentiment_score_mean,
         d.overall_sentiment_score_mean_label, CAST({NOW_EARLIER_MILLIS} AS BIGINT) AS timestamp,
         q.current_price AS current_price
  FROM daily_l d LEFT JOIN quotes q ON d.symbol = q.symbol),
merged AS (
  SELECT * FROM comb
  UNION ALL
  SELECT * FROM first_load f
  WHERE NOT EXISTS (SELECT 1 FROM comb c WHERE c.symbol = f.symbol AND c.date IS NOT DISTINCT FROM f.date))
{O.documents_select('merged')}""",
        "quarantine": O.with_(O.EV, O.MIXED)
        + """SELECT symbol, topic, coalesce(reason, 'ok') AS reason, count(*) AS messages FROM mixed GROUP BY ALL""",
        "landed_quarantine": O.with_(O.EV, O.MIXED)
        + """SELECT CASE WHEN topic = 'ingest_news_topic' THEN 'news' ELSE 'prices' END AS kind, symbol, reason,
       count(*) AS documents, count(*) FILTER (reason = 'broken') AS records
FROM mixed WHERE reason IS NOT NULL GROUP BY ALL""",
        "landing_stamps": O.with_(O.EV, O.MIXED)
        + f"""SELECT symbol AS ticker, '{NOW}' AS ingest_ts, count(*) AS documents
FROM mixed WHERE reason IS DISTINCT FROM 'broken' GROUP BY 1""",
        "quotes_as_of": O.with_(O.EV)
        + f"""SELECT n.event_id AS event_id, n.symbol AS symbol, {O.snap('q.price')} AS current_price
FROM (SELECT * FROM ev WHERE event_type <> 'purchase') n
ASOF LEFT JOIN (SELECT symbol, ts, max(value) AS price FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2) q
ON n.symbol = q.symbol AND n.ts >= q.ts""",
        "bench_combine": O.with_(O.SEG, O.ORD_NEWS, O.DAILY, O.ORD_BARS, O.combined(ORD_AS_OF, NOW_MILLIS))
        + O.combined_select(),
    }


def queries() -> dict[str, Query]:
    from tickcast.plans.stream_queries import STREAM_QUERIES

    return {name: _ensured(fn) for name, fn in {**QUERIES, **STREAM_QUERIES}.items()}


def oracle_sql() -> dict[str, str]:
    o = _oracles()
    o["compacted_documents"] = o["upsert_documents"]
    o["predict_incremental"] = o["predict_next_close"]
    o["stream_format_news"] = o["format_news"]
    o["stream_format_prices"] = o["format_prices"]
    o["stream_daily_sentiment"] = o["daily_sentiment"]
    o["stream_late"] = O.late_articles(o["daily_sentiment"], proxy.ITEMS_PER_DOCUMENT)
    o["stream_pair"] = o["pair_latest_reset"]
    o["stream_reorder"] = o["pair_latest_reset"]
    o["stream_recent"] = o["recent_news_topk"]
    o["run_batch_available_now"] = o["documents"]
    o["run_batch"] = o["documents"]
    o["periodic_runs"] = o["documents"]
    o["stream_combine"] = O.stream_combined(
        STREAM_AS_OF, NOW, proxy.ITEMS_PER_DOCUMENT, proxy.EVENTS_PER_FETCH, proxy.DAYS_PER_FETCH, proxy.FIRST_FETCH
    )
    o["stream_pipeline"] = o["stream_combine"]
    return o
