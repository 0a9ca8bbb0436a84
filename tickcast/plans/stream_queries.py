"""Registered streaming queries: each writes replayable message files from
the test tables, runs the Structured Streaming query to completion with
``trigger(availableNow=True)`` and checkpoints in the shared checkpoint
folder, then returns the sink read back as a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.operators.combine import latest_quotes
from tickcast.plans.queries import (
    EV_AS_OF,
    STREAM_AS_OF,
    NOW,
    RECENT_FROM,
    RECENT_LIMIT,
    iso_time,
    report_bars,
    report_combined,
    report_daily,
    report_news,
)
from tickcast.session import scratch_path, session_conf, stream_settings
from tickcast.sources import proxy
from tickcast.sources.documents import news_rows, price_rows
from tickcast.schemas import MESSAGE
from tickcast.sources.snapshots import remove
from tickcast.sources.sinks import DOCUMENT_STORED, land, read_documents, write_batch
from tickcast.streaming.formatting import format_stream
from tickcast.streaming.late import late_sink, partial_daily, read_daily, read_late, read_partials
from tickcast.streaming.pairing import pair_batches
from tickcast.streaming.recent import read_recent, recent_sink
from tickcast.streaming.reorder import flush, reorder_batches
from tickcast.streaming.jobs import (
    PipelineConfig,
    StreamConfig,
    combine_sink,
    daily_sentiment_stream,
    latest_rows,
    run_available_now,
    run_batch,
    start_stream,
    upsert_batches,
)
from tickcast.streaming.sources import (
    FORMAT_NEWS,
    FORMAT_PRICES,
    INGEST_NEWS,
    INGEST_PRICES,
    as_messages,
    topic_stream,
    write_message_files,
)


def _ingest_messages(spark: SparkSession, sf_dir: str, path: str, prices: DataFrame | None = None) -> None:
    """Raw news and price documents (plus broken payloads) as ingest-topic
    message files."""
    news = proxy.event_news_documents(spark, sf_dir)
    prices = prices if prices is not None else proxy.event_price_documents(spark, sf_dir)
    broken = proxy.event_payloads(spark, sf_dir).filter(~F.col("value").startswith('{"'))
    msgs = (
        as_messages(news, INGEST_NEWS, "symbol", "value", "seq", "fetched_at")
        .unionByName(as_messages(prices, INGEST_PRICES, "symbol", "value", "seq", "last_refreshed"))
        .unionByName(as_messages(broken, INGEST_NEWS, "symbol", "value", "seq"))
    )
    write_message_files(msgs, path)


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _formatted(spark: SparkSession, sf_dir: str, prices: DataFrame | None = None) -> tuple[str, str]:
    """T1, T2, T6, T7 + S8: ingest messages → formatted message files and
    a quarantine table; returns (formatted path, quarantine path)."""
    base = scratch_path(spark, "stream")
    _ingest_messages(spark, sf_dir, f"{base}/ingest", prices)
    src = topic_stream(spark, [INGEST_NEWS, INGEST_PRICES], path=f"{base}/ingest")
    formatted, bad = format_stream(src)
    q1 = (
        formatted.writeStream.format("json").option("path", f"{base}/formatted")
        .option("checkpointLocation", f"{base}/ckpt/formatted").trigger(availableNow=True).start()
    )
    q2 = (
        bad.writeStream.format("parquet").option("path", f"{base}/quarantine")
        .option("checkpointLocation", f"{base}/ckpt/quarantine").trigger(availableNow=True).start()
    )
    _run(q1)
    _run(q2)
    return f"{base}/formatted", f"{base}/quarantine"


def q_stream_format_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed news documents → formatted messages,
    read back as rows."""
    formatted, _ = _formatted(spark, sf_dir)
    msgs = spark.read.schema("key string, value string, topic string, offset long").json(formatted)
    return report_news(news_rows(msgs.filter(F.col("topic") == FORMAT_NEWS)))


def q_stream_format_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed price documents → formatted messages."""
    formatted, _ = _formatted(spark, sf_dir)
    msgs = spark.read.schema("key string, value string, topic string, offset long").json(formatted)
    return report_bars(price_rows(msgs.filter(F.col("topic") == FORMAT_PRICES)))


def q_stream_daily_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sentiment on the stream (watermark, daily event-time
    windows, update mode, newest value per key)."""
    base = scratch_path(spark, "stream")
    _ingest_messages(spark, sf_dir, f"{base}/ingest")
    src = topic_stream(spark, [INGEST_NEWS, INGEST_PRICES], path=f"{base}/ingest")
    formatted, _ = format_stream(src)
    rows = news_rows(formatted.filter(F.col("topic") == FORMAT_NEWS))
    daily = daily_sentiment_stream(rows, watermark="1 day")
    q = (
        daily.writeStream.outputMode("update").foreachBatch(upsert_batches(f"{base}/daily"))
        .option("checkpointLocation", f"{base}/ckpt/daily").trigger(availableNow=True).start()
    )
    _run(q)
    return report_daily(latest_rows(spark, f"{base}/daily", ["symbol", "date"]))


def q_stream_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message log in three portions, each a run of micro-batches that
    take up the open slots of the ones before; equals the batch pair-and-reset."""
    base = scratch_path(spark, "stream")
    topic = F.when(F.col("kind") == "news", F.lit(FORMAT_NEWS)).otherwise(F.lit(FORMAT_PRICES))
    log = proxy.event_messages(spark, sf_dir).withColumn("topic", topic)
    msgs = log.select(F.col("symbol").alias("key"), "value", "topic", F.col("seq").alias("offset"), "timestamp")
    end = msgs.agg(F.max("offset")).first()[0] or 0

    def keep(pairs: DataFrame, batch_id: int) -> None:
        write_batch(pairs.select("symbol", "seq", "news_seq", "prices_seq"), f"{base}/pairs", batch_id)

    for i in range(3):
        part = F.least(F.floor(F.col("offset") * 3 / F.lit(end + 1)), F.lit(2)) == i
        write_message_files(msgs.filter(part), f"{base}/messages")
        src = topic_stream(spark, [FORMAT_NEWS, FORMAT_PRICES], path=f"{base}/messages")
        pairs = pair_batches(f"{base}/slots", keep)
        _run(src.writeStream.foreachBatch(pairs).option("checkpointLocation", f"{base}/ckpt/pairs").trigger(availableNow=True).start())
    schema = "symbol string, seq long, news_seq long, prices_seq long"
    return spark.read.schema(schema).parquet(f"{base}/pairs").select("symbol", "seq", "news_seq", "prices_seq")


def q_stream_reorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message log in three portions with every message moved by up
    to 400 places, put in order by time again ahead of pairing; equals the batch
    pair-and-reset. A message's time is its place in the log, in seconds."""
    base = scratch_path(spark, "stream")
    topic = F.when(F.col("kind") == "news", F.lit(FORMAT_NEWS)).otherwise(F.lit(FORMAT_PRICES))
    log = proxy.event_messages(spark, sf_dir).withColumn("topic", topic)
    msgs = log.select(F.col("symbol").alias("key"), "value", "topic", F.col("seq").alias("offset"), F.timestamp_seconds("seq").alias("timestamp"))
    end = msgs.agg(F.max("offset")).first()[0] or 0
    place = F.col("offset") + F.pmod(F.xxhash64("offset"), F.lit(400))

    def keep(pairs: DataFrame, batch_id: int) -> None:
        write_batch(pairs.select("symbol", "seq", "news_seq", "prices_seq"), f"{base}/pairs", batch_id)

    pairs = pair_batches(f"{base}/slots", keep)
    for i in range(3):
        part = F.least(F.floor(place * 3 / F.lit(end + 400)), F.lit(2)) == i
        write_message_files(msgs.filter(part), f"{base}/messages")
        src = topic_stream(spark, [FORMAT_NEWS, FORMAT_PRICES], path=f"{base}/messages")
        ordered = reorder_batches(f"{base}/buffer", pairs, "400 seconds")
        _run(src.writeStream.foreachBatch(ordered).option("checkpointLocation", f"{base}/ckpt/pairs").trigger(availableNow=True).start())
    flush(spark, f"{base}/buffer", pairs)
    schema = "symbol string, seq long, news_seq long, prices_seq long"
    return spark.read.schema(schema).parquet(f"{base}/pairs").select("symbol", "seq", "news_seq", "prices_seq")


def q_stream_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles in three portions in no order of time; the newest 200
    of each ticker since the start of a day from the lists kept by day."""
    base = scratch_path(spark, "stream")
    news = proxy.event_news(spark, sf_dir, with_id=True)
    sink = recent_sink(f"{base}/recent", "event_id", RECENT_LIMIT, days=14)
    for i in range(3):
        news.filter(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i).write.mode("append").parquet(f"{base}/news")
        src = spark.readStream.schema(news.schema).parquet(f"{base}/news")
        _run(src.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    top = read_recent(spark, f"{base}/recent", "event_id", RECENT_LIMIT, RECENT_FROM)
    return top.select("ticker", "event_id", iso_time("time_published").alias("time_published"), F.col("rank").cast("long").alias("rank"))


def q_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News messages out of order in three portions; articles of days closed
    by a day's watermark go to the late table. Daily sentiment over both, and
    how many articles were in time and late."""
    base = scratch_path(spark, "stream")
    docs = proxy.event_news_documents(spark, sf_dir)
    sink = late_sink(f"{base}/news", "1 day")
    for i in range(3):
        part = docs.filter(F.col("block") % 3 == i)
        write_message_files(as_messages(part, INGEST_NEWS, "symbol", "value", "seq", "fetched_at"), f"{base}/ingest")
        # one micro-batch a portion
        formatted, _ = format_stream(topic_stream(spark, [INGEST_NEWS], path=f"{base}/ingest", max_per_trigger=1 << 30))
        rows = news_rows(formatted)
        _run(rows.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    daily = report_daily(read_daily(spark, f"{base}/news", with_late=True))
    late = partial_daily(read_late(spark, f"{base}/news").drop("_batch"))
    both = read_partials(spark, f"{base}/news").select("symbol", "date", F.col("articles").alias("in_time"), F.lit(0).alias("late"))
    both = both.unionByName(late.select("symbol", "date", F.lit(0).alias("in_time"), F.col("articles").alias("late")))
    counts = both.groupBy(F.col("symbol").alias("_s"), F.date_format("date", "yyyy-MM-dd").alias("_d")).agg(F.sum("in_time").alias("in_time"), F.sum("late").alias("late"))
    return daily.join(counts, F.col("symbol").eqNullSafe(F.col("_s")) & F.col("date").eqNullSafe(F.col("_d"))).drop("_s", "_d")


def q_stream_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted document messages (price documents fetched
    again and again) → pairs per symbol → foreachBatch combine of each pair →
    documents and combined messages."""
    formatted, _ = _formatted(spark, sf_dir, proxy.event_price_fetches(spark, sf_dir))
    base = scratch_path(spark, "stream")
    quotes = latest_quotes(proxy.quote_payloads(proxy.event_bars(spark, sf_dir)))
    src = topic_stream(spark, [FORMAT_NEWS, FORMAT_PRICES], path=formatted)
    combined = combine_sink(f"{base}/documents", f"{base}/combined", quotes, STREAM_AS_OF, NOW)
    q = (
        src.writeStream.foreachBatch(pair_batches(f"{base}/slots", combined))
        .option("checkpointLocation", f"{base}/ckpt/combine").trigger(availableNow=True).start()
    )
    _run(q)
    return _streamed_documents(spark, f"{base}/documents")


def _streamed_documents(spark: SparkSession, path: str) -> DataFrame:
    docs = read_documents(spark, path, schema=DOCUMENT_STORED.replace("timestamp long", "timestamp timestamp"))
    return report_combined(docs.withColumn("timestamp", iso_time("timestamp")), keep=["index"])


def q_stream_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole streaming pipeline over message files;
    documents come from the combined messages. These are then all written once
    more, as a repeated micro-batch does to a topic, which changes no document."""
    base = scratch_path(spark, "stream")
    _ingest_messages(spark, sf_dir, f"{base}/messages/ingest", proxy.event_price_fetches(spark, sf_dir))
    quotes = latest_quotes(proxy.quote_payloads(proxy.event_bars(spark, sf_dir)))
    cfg = StreamConfig(f"{base}/messages", f"{base}/documents", f"{base}/ckpt", quotes=quotes, as_of=STREAM_AS_OF, now=NOW)
    for q in start_stream(spark, cfg, {"availableNow": True}):
        _run(q)
    again = spark.read.schema(MESSAGE).json(f"{cfg.messages}/combined")
    again.write.mode("append").json(f"{cfg.messages}/combined/_batch=-1")
    for q in start_stream(spark, cfg, {"availableNow": True}):
        _run(q)
    return _streamed_documents(spark, cfg.documents)


def q_run_batch_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic batch run as an availableNow query over the
    landing folder, then combine and upsert documents."""
    base = scratch_path(spark, "pipeline")
    land(proxy.event_news_documents(spark, sf_dir), f"{base}/landing", "news")
    land(proxy.event_price_documents(spark, sf_dir), f"{base}/landing", "prices")
    quotes = latest_quotes(proxy.quote_payloads(proxy.event_bars(spark, sf_dir)))
    cfg = PipelineConfig(
        landing=f"{base}/landing", formatted=f"{base}/formatted", documents=f"{base}/documents",
        checkpoint=f"{base}/ckpt", quotes=quotes, as_of=EV_AS_OF, now=NOW,
    )
    run_available_now(spark, cfg, load_id=1)
    return report_combined(read_documents(spark, cfg.documents), keep=["index"])


def _kept(df: DataFrame, path: str, *parts: str) -> DataFrame:
    """``df`` written once and read back: every use of it is a scan."""
    df.write.partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three periodic runs over a growing landing folder (price documents
    are fetched again); each combines only what its files touch. Documents equal
    those of one run over all."""
    base = scratch_path(spark, "pipeline")
    # what upstream holds: the documents of all portions and the quotes, made once
    upstream = f"{base}/upstream"
    part = F.pmod(F.xxhash64("symbol", "seq"), F.lit(3)).alias("part")
    news = _kept(proxy.event_news_documents(spark, sf_dir).select("symbol", "value", part), f"{upstream}/news", "part")
    prices = _kept(proxy.event_price_documents(spark, sf_dir).select("symbol", "value", part), f"{upstream}/prices", "part")
    quotes = _kept(latest_quotes(proxy.quote_payloads(proxy.event_bars(spark, sf_dir))), f"{upstream}/quotes")
    cfg = PipelineConfig(
        landing=f"{base}/landing", formatted=f"{base}/formatted", documents=f"{base}/documents",
        checkpoint=f"{base}/ckpt", quotes=quotes, as_of=EV_AS_OF, now=NOW,
    )
    for i in range(3):
        land(news.filter(F.col("part") == i), cfg.landing, "news")
        land(prices.filter(F.col("part") == i) if i else prices, cfg.landing, "prices")
        run_available_now(spark, cfg, load_id=i)
    remove(spark, upstream)
    return report_combined(read_documents(spark, cfg.documents), keep=["index"])


def q_run_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch run over landed documents that carry no ticker of
    their own (the layout has it), formatted tables, documents."""
    base = scratch_path(spark, "pipeline")
    bare = F.regexp_replace("value", r',"ticker":"[^"]*"\}$', "}")
    land(proxy.event_news_documents(spark, sf_dir).withColumn("value", bare), f"{base}/landing", "news")
    land(proxy.event_price_documents(spark, sf_dir), f"{base}/landing", "prices")
    quotes = latest_quotes(proxy.quote_payloads(proxy.event_bars(spark, sf_dir)))
    cfg = PipelineConfig(
        landing=f"{base}/landing", formatted=f"{base}/formatted", documents=f"{base}/documents",
        checkpoint=f"{base}/ckpt", quotes=quotes, as_of=EV_AS_OF, now=NOW,
    )
    run_batch(spark, cfg)
    return report_combined(read_documents(spark, cfg.documents), keep=["index"])


def _sized(fn):
    """Run a streaming query with its state partitions sized to the cores."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with session_conf(spark, stream_settings(spark)):
            return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


STREAM_QUERIES = {
    "stream_format_news": _sized(q_stream_format_news),
    "stream_format_prices": _sized(q_stream_format_prices),
    "stream_daily_sentiment": _sized(q_stream_daily_sentiment),
    "stream_pair": _sized(q_stream_pair),
    "stream_reorder": _sized(q_stream_reorder),
    "stream_recent": _sized(q_stream_recent),
    "stream_late": _sized(q_stream_late),
    "stream_combine": _sized(q_stream_combine),
    "stream_pipeline": _sized(q_stream_pipeline),
    "run_batch_available_now": _sized(q_run_batch_available_now),
    "periodic_runs": _sized(q_periodic_runs),
    "run_batch": q_run_batch,
}
