"""Streaming pipeline stages (T4, T5, T8, T9) and their sinks.

* T9 ``daily_sentiment_stream``: event-time daily windows with a watermark,
  so per-day state is dropped once the watermark passes the day.
* T4/T5 ``combine_pairs``: the micro-batch function run by ``foreachBatch``
  on the stream of emitted pairs — the batch combine on exactly the rows of
  each pair, then per-symbol documents and combined messages.
* T8 ``run_available_now``: the periodic batch run as a streaming query with
  ``trigger(availableNow=True)``: only files landed since the last run are
  formatted, only the news days they touch are read again, and only the
  symbols they touch are combined, from daily tables.
* C6 ``start_stream``: the whole streaming pipeline — ingest topics →
  formatted topics → pairs → combined topic → documents.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickcast.functions.scalar import symbol_from_path
from tickcast.operators.combine import combine
from tickcast.operators.forecast import as_of_date, predict_next_close
from tickcast.operators.formatting import format_news, format_prices, latest_articles
from tickcast.operators.sentiment import daily_sentiment, labelled_daily, sentiment_aggregates
from tickcast.schemas import META_DATA, META_LAST_REFRESHED, NEWS, PRICES, RAW_NEWS, RAW_PRICES
from tickcast.sources.documents import combined_rows, explode_row_batches
from tickcast.sources.sinks import to_messages, write_batch, write_documents, write_parquet
from tickcast.sources.snapshots import drop_old, merge_snapshot
from tickcast.streaming.formatting import format_stream
from tickcast.operators.pairing import DEFAULT_CHUNK
from tickcast.streaming.pairing import pair_batches
from tickcast.streaming.reorder import TIME_CHUNK, broker_order, flush, reorder_batches
from tickcast.streaming.sources import COMBINED, FORMAT_NEWS, FORMAT_PRICES, INGEST_NEWS, INGEST_PRICES, topic_stream, write_topic

PAIR_SEP = "#"


# --------------------------------------------------------------------- T9
def daily_sentiment_stream(news_rows: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Formatted news rows (streaming) → daily sentiment per (symbol, UTC
    day), updated as articles arrive; run in ``update`` output mode. Rows
    without a publication time have no window: :func:`untimed_sentiment_stream`
    counts them."""
    rows = news_rows.withWatermark("time_published", watermark)
    day = F.window("time_published", "1 day").alias("w")
    agg = rows.groupBy(F.col("ticker").alias("symbol"), day).agg(*sentiment_aggregates())
    return labelled_daily(agg.withColumn("date", F.to_date("w.start")))


def untimed_sentiment_stream(news_rows: DataFrame) -> DataFrame:
    """The NULL-date rows of daily sentiment on the stream: one per symbol
    (the state is one row per symbol, so it needs no watermark); ``update``
    output mode, into the same sink as :func:`daily_sentiment_stream`."""
    rows = news_rows.filter(F.col("time_published").isNull())
    agg = rows.groupBy(F.col("ticker").alias("symbol")).agg(*sentiment_aggregates())
    return labelled_daily(agg.withColumn("date", F.lit(None).cast("date")))


def upsert_batches(path: str):
    """foreachBatch sink for update-mode results: append each micro-batch
    with its batch id; readers keep the newest row per key (see
    :func:`latest_rows`)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    return write


def latest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The rows of each key's last micro-batch: the batch id is reduced by
    hash, then the rows that carry it are taken."""
    df = spark.read.parquet(path)
    last = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max("_batch").alias("_last"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_batch") == F.col("_last")]
    return df.join(last, same, "left_semi").drop("_batch")


# --------------------------------------------------------------------- T4/T5
def pair_rows(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Emitted pairs → (news rows, price rows) of each pair. The batch
    operators are keyed by symbol, so for the length of one micro-batch the
    symbol column carries ``symbol#seq``: two pairs of one symbol in the same
    micro-batch stay two separate combines, as in the reference."""
    pk = F.concat_ws(PAIR_SEP, F.col("symbol"), F.col("seq").cast("string"))
    news = explode_row_batches(pairs.select(pk.alias("_pair"), F.col("news_value").alias("value")), NEWS, keep=["_pair"])
    prices = explode_row_batches(pairs.select(pk.alias("_pair"), F.col("prices_value").alias("value")), PRICES, keep=["_pair"])
    return (
        news.withColumn("ticker", F.col("_pair")).drop("_pair"),
        prices.withColumn("symbol", F.col("_pair")).drop("_pair"),
    )


def combine_pairs(
    pairs: DataFrame,
    quotes: DataFrame | None = None,
    as_of: str | None = None,
    now: str | None = None,
) -> DataFrame:
    """T4: the streaming combine of a batch of pairs: no fallback, the
    processing time as a timestamp (F7). Adds ``pair_seq``."""
    news, prices = pair_rows(pairs)
    combined = combine(
        predict_next_close(prices, as_of, persist=False),
        daily_sentiment(news),
        None,
        processing="timestamp",
        now=now,
        fallback=False,
    )
    # the sequence follows the last separator; a symbol may hold one itself
    seq = F.substring_index("symbol", PAIR_SEP, -1)
    own = F.expr(f"substring(symbol, 1, length(symbol) - length(substring_index(symbol, '{PAIR_SEP}', -1)) - {len(PAIR_SEP)})")
    out = combined.withColumn("pair_seq", seq.cast("long")).withColumn("symbol", own)
    if quotes is not None:
        out = out.drop("current_price").join(quotes.select("symbol", "current_price"), "symbol", "left")
    return out


def combine_sink(documents: str | None, messages: str | None = None, quotes: DataFrame | None = None,
                 as_of: str | None = None, now: str | None = None, bootstrap_servers: str | None = None):
    """T5 (+S9): foreachBatch function writing the combined rows of each
    micro-batch as per-symbol documents, as message files, or both; with
    ``bootstrap_servers`` the messages go to the combined topic instead. A
    message carries its ``pair_seq``: a repeated micro-batch writes to a topic
    again, and the consumer drops the copies (:func:`once`)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # else each branch runs the pairing state again
        out = combine_pairs(batch, quotes, as_of, now).persist()
        try:
            if documents:
                write_documents(out.drop("pair_seq"), documents, mode="append", batch_id=batch_id)
            msgs = to_messages(out, "symbol").withColumn("timestamp", F.current_timestamp())
            if bootstrap_servers:
                write_topic(msgs, COMBINED, bootstrap_servers)
            elif messages:
                write_batch(msgs.withColumn("topic", F.lit(COMBINED)), messages, batch_id, fmt="json")
        finally:
            out.unpersist()
            batch.unpersist()

    return write


# --------------------------------------------------------------------- C6
@dataclass
class StreamConfig:
    """One streaming deployment. The topics are Kafka's with
    ``bootstrap_servers``, else the folders <messages>/ingest, formatted and
    combined of JSON message files; all paths are on shared storage."""

    messages: str
    documents: str
    checkpoint: str
    bootstrap_servers: str | None = None
    quotes: DataFrame | None = None  # (symbol, current_price)
    as_of: str | None = None
    now: str | None = None
    max_per_trigger: int | None = None  # bounds a micro-batch, the first one too (None: topic_stream's default)
    replay_within: str = "1 hour"  # how late a topic message may come again
    reorder_within: str | None = None  # formatted messages this far out of order are put in order ahead of pairing


def _folder(spark: SparkSession, path: str) -> str:
    """``path``, created if need be: a file stream starts on an empty folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def once(messages: DataFrame, within: str = "1 hour") -> DataFrame:
    """Combined messages (streaming), each (symbol, pair, date) once: copies
    that follow within ``within`` of the first, by message time, are dropped.
    State is one key a message, for that long. Messages without a ``pair_seq``
    have no identity and all pass."""
    field = lambda name: F.get_json_object("value", f"$.{name}")
    ident = F.to_json(F.array(field("symbol"), field("pair_seq"), field("date")))
    own = F.when(field("pair_seq").isNull(), F.uuid()).otherwise(ident)
    timed = messages.withColumn("timestamp", F.coalesce("timestamp", F.current_timestamp())).withColumn("_id", own)
    return timed.withWatermark("timestamp", within).dropDuplicatesWithinWatermark(["_id"]).drop("_id")


def index_sink(documents: str):
    """T5: foreachBatch function writing combined messages as documents, one
    per message (append, as the reference)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_documents(combined_rows(batch), documents, mode="append", batch_id=batch_id)

    return write


def start_stream(spark: SparkSession, cfg: StreamConfig, trigger: dict | None = None) -> list[StreamingQuery]:
    """Start the four queries of the streaming pipeline (format,
    quarantine, combine, index) and return them running. With
    ``trigger={"availableNow": True}`` each one drains what the one before
    wrote, and all are finished on return."""
    drain = bool((trigger or {}).get("availableNow"))
    started: list[StreamingQuery] = []

    def source(topics: list[str], folder: str) -> DataFrame:
        path = None if cfg.bootstrap_servers else _folder(spark, f"{cfg.messages}/{folder}")
        return topic_stream(spark, topics, path, cfg.bootstrap_servers, max_per_trigger=cfg.max_per_trigger)

    def start(writer, name: str) -> None:
        writer = writer.option("checkpointLocation", f"{cfg.checkpoint}/{name}")
        query = (writer.trigger(**trigger) if trigger else writer).start()
        started.append(query)
        if drain:
            query.awaitTermination()

    formatted, bad = format_stream(source([INGEST_NEWS, INGEST_PRICES], "ingest"))
    if cfg.bootstrap_servers:
        sink = formatted.select("topic", "key", "value").writeStream.format("kafka").option("kafka.bootstrap.servers", cfg.bootstrap_servers)
    else:
        sink = formatted.writeStream.format("json").option("path", f"{cfg.messages}/formatted")
    start(sink, "format")
    start(bad.writeStream.format("parquet").option("path", f"{cfg.messages}/quarantine"), "quarantine")

    # offsets order one topic partition; the broker's time orders both topics
    by_time = bool(cfg.bootstrap_servers or cfg.reorder_within)
    seq, chunk = (broker_order(), TIME_CHUNK) if by_time else ("offset", DEFAULT_CHUNK)
    combined = combine_sink(None, f"{cfg.messages}/combined", cfg.quotes, cfg.as_of, cfg.now, cfg.bootstrap_servers)
    pairs = pair_batches(f"{cfg.checkpoint}/slots", combined, seq=seq, chunk_size=chunk)
    buffer = f"{cfg.checkpoint}/buffer"
    ordered = reorder_batches(buffer, pairs, cfg.reorder_within) if cfg.reorder_within else pairs
    start(source([FORMAT_NEWS, FORMAT_PRICES], "formatted").writeStream.foreachBatch(ordered), "combine")
    if drain and cfg.reorder_within:
        flush(spark, buffer, pairs)  # the log has ended
    messages = once(source([COMBINED], "combined"), cfg.replay_within)
    start(messages.writeStream.foreachBatch(index_sink(cfg.documents)), "index")
    return started


# --------------------------------------------------------------------- T8
@dataclass
class PipelineConfig:
    """Paths of one deployment; all on shared storage."""

    landing: str  # raw documents: <landing>/kind=news|prices/symbol=<s>/
    formatted: str  # formatted tables: <formatted>/news, <formatted>/prices
    documents: str  # per-symbol documents
    checkpoint: str  # streaming checkpoints
    quotes: DataFrame | None = None  # (symbol, current_price)
    as_of: str | None = None  # split date; None = yesterday
    now: str | None = None  # processing clock; None = now
    documents_mode: str = "upsert"


FETCHED = "_fetched"


def _fetch_order(raw: DataFrame) -> DataFrame:
    """Document order of landed price documents: the document's own
    refresh date, then the landing file's time and name (deterministic)."""
    return raw.withColumn(
        FETCHED,
        F.struct(
            F.col(f"`{META_DATA}`")[META_LAST_REFRESHED].alias("refreshed"),
            F.col("_metadata.file_modification_time").alias("landed"),
            F.col("_metadata.file_path").alias("path"),
        ),
    )


def _news_order(raw: DataFrame) -> DataFrame:
    """Document order of landed news documents: landing time, then name."""
    return raw.withColumn(
        FETCHED,
        F.struct(
            F.col("_metadata.file_modification_time").alias("landed"),
            F.col("_metadata.file_path").alias("path"),
        ),
    )


def _format_landed_news(raw: DataFrame, ticker="ticker") -> DataFrame:
    return format_news(_news_order(raw), ticker=ticker, keep=[FETCHED], article_fields=["url"])


def landed_ticker() -> Column:
    return F.coalesce(F.col("ticker"), symbol_from_path("_path"))


def format_landed(spark: SparkSession, cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """C1 + C2 over everything landed (batch); price rows keep their
    document order so overlapping documents can be resolved."""
    # a landed document need not carry its ticker; the layout does
    news = spark.read.schema(RAW_NEWS).json(f"{cfg.landing}/kind=news").withColumn("_path", F.col("_metadata.file_path"))
    prices = spark.read.schema(RAW_PRICES).json(f"{cfg.landing}/kind=prices")
    return _format_landed_news(news, landed_ticker()), format_prices(_fetch_order(prices), keep=[FETCHED])


def landed_sentiment(news: DataFrame) -> DataFrame:
    """Daily sentiment of news rows of many fetches: each article of a day from
    its latest document (one published anew under another day counts there too)."""
    news = news.withColumn("_day", F.to_date("time_published"))
    return daily_sentiment(latest_articles(news, FETCHED, day="_day"))


def combine_formatted(spark: SparkSession, cfg: PipelineConfig, news: DataFrame, prices: DataFrame) -> DataFrame:
    """Combine over formatted tables that hold many fetches: each article
    from its latest document, each price day from its latest document."""
    predicted = predict_next_close(prices, cfg.as_of, dedup_by=FETCHED)
    return combine(predicted, landed_sentiment(news), cfg.quotes, "millis", cfg.now)


def load_number(load_id: int | None) -> int:
    """The caller's load id, or one that grows with time."""
    return time.time_ns() // 1_000_000 if load_id is None else load_id


def run_batch(spark: SparkSession, cfg: PipelineConfig, load_id: int | None = None) -> None:
    """The whole batch pipeline: landed documents → formatted tables
    (S7, rewritten) → combined → documents. The formatted tables are written
    and read back, which also cuts the lineage before the combine. Use either
    this or :func:`run_available_now` on one ``formatted`` folder."""
    news, prices = format_landed(spark, cfg)
    write_parquet(news, f"{cfg.formatted}/news", mode="overwrite")
    write_parquet(prices, f"{cfg.formatted}/prices", mode="overwrite")
    news = spark.read.parquet(f"{cfg.formatted}/news")
    prices = spark.read.parquet(f"{cfg.formatted}/prices")
    write_documents(combine_formatted(spark, cfg, news, prices), cfg.documents, cfg.documents_mode, load_number(load_id))


TOUCHED = "kind string, symbol string, day date, _batch long"
RUNS = "run long, news long, prices long, as_of date"


def _landed_rows(raw: DataFrame, kind: str) -> DataFrame:
    """Formatted rows of landed documents (the document order is carried)."""
    if kind == "news":
        rows = format_news(raw, ticker=landed_ticker(), keep=[FETCHED], article_fields=["url"])
        return rows.withColumn("day", F.to_date("time_published"))
    return format_prices(raw, keep=[FETCHED]).withColumn("date", F.to_date("date"))


def _append_formatted(path: str, kind: str):
    """foreachBatch function: the formatted rows of new files, news in folders
    of a day, and the (symbol, day) of every row as a table of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = _landed_rows(batch, kind)
        # else every task leaves a file in every day it touches; large days are split
        out = rows.hint("rebalance", F.col("day")) if kind == "news" else rows
        write_batch(out, f"{path}/{kind}", batch_id, ["day"] if kind == "news" else None)
        # the documents are parsed once: the touched days come from the rows written
        symbol, day = ("ticker", "day") if kind == "news" else ("symbol", "date")
        spark = batch.sparkSession
        written = spark.read.schema(f"{symbol} string, {day} date, _batch long").parquet(_folder(spark, f"{path}/{kind}"))
        seen = written.filter(F.col("_batch") == batch_id).select(F.col(symbol).alias("symbol"), F.col(day).alias("day")).distinct()
        write_batch(seen, f"{path}/touched/kind={kind}", batch_id)

    return write


def touched_articles(spark: SparkSession, news: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows of ``news`` (partitioned by ``day``) of the touched (symbol, day)
    pairs. The days are a partition filter; there are as many as the calendar has."""
    days = [r.day for r in touched.select("day").distinct().collect()]
    known = F.col("day").isin([d for d in days if d is not None])
    rows = news.filter(known | F.col("day").isNull() if None in days else known)
    pairs = touched.select(F.col("symbol").alias("_s"), F.col("day").alias("_d")).distinct()
    return rows.join(pairs, F.col("ticker").eqNullSafe(F.col("_s")) & F.col("day").eqNullSafe(F.col("_d")), "left_semi")


def combine_touched(spark: SparkSession, cfg: PipelineConfig, schemas: dict[str, T.StructType], load_id: int | None) -> None:
    """The combine of a periodic run: the news of touched days become rows of
    the daily sentiment table, new price rows rows of the bars table (both
    :mod:`tickcast.sources.snapshots`, a part a month), and the touched symbols'
    documents are made from these two daily tables. A symbol's model changes
    with any of its bars, hence all its documents; no article of an untouched
    day is read. Documents of an earlier run stay unless a newer one of their
    day replaces them: fallback rows of a symbol whose first prices come later
    are not taken back, as in the reference's append. With another split date every symbol counts as touched. A run
    that failed is taken up by the next one: the batches since the last
    finished run are its input."""
    path = cfg.formatted
    split = spark.range(1).select(as_of_date(cfg.as_of).alias("d")).first().d
    last = spark.read.schema(RUNS).parquet(_folder(spark, f"{path}/runs")).orderBy(F.desc("run")).limit(1).collect()
    run, seen = (last[0].run + 1, {"news": last[0].news, "prices": last[0].prices}) if last else (1, {"news": -1, "prices": -1})
    fresh = (F.col("_batch") > F.when(F.col("kind") == "news", seen["news"]).otherwise(seen["prices"]))
    touched = spark.read.schema(TOUCHED).parquet(_folder(spark, f"{path}/touched")).filter(fresh).persist()
    try:
        top = {r.kind: r.top for r in touched.groupBy("kind").agg(F.max("_batch").alias("top")).collect()}
        moved = not last or last[0].as_of != split
        if not top and not moved:
            return
        news = spark.read.schema(T.StructType([*schemas["news"].fields, T.StructField("_batch", T.LongType())])).parquet(_folder(spark, f"{path}/news"))
        prices = spark.read.schema(T.StructType([*schemas["prices"].fields, T.StructField("_batch", T.LongType())])).parquet(_folder(spark, f"{path}/prices"))
        day_news = touched_articles(spark, news.drop("_batch"), touched.filter("kind = 'news'"))
        month = F.date_format("date", "yyyy-MM")
        daily = merge_snapshot(spark, f"{path}/daily", landed_sentiment(day_news).withColumn("_run", F.lit(run).cast("long")),
                               ["symbol", "date"], "_run", month, run)
        new_bars = prices.filter(F.col("_batch") > seen["prices"]).drop("_batch")
        bars = merge_snapshot(spark, f"{path}/bars", new_bars, ["symbol", "date"], FETCHED, month, run)
        daily = daily.drop("_run")
        if not moved:
            own = touched.select(F.col("symbol").alias("_s")).distinct()
            same = F.col("symbol").eqNullSafe(F.col("_s"))
            daily, bars = daily.join(own, same, "left_semi"), bars.join(own, same, "left_semi")
        # the bars table holds one row a symbol and day already
        predicted = predict_next_close(bars.drop(FETCHED), cfg.as_of, persist=False)
        out = combine(predicted, daily, cfg.quotes, "millis", cfg.now)
        write_documents(out, cfg.documents, cfg.documents_mode, load_number(load_id))
        done = [(run, top.get("news", seen["news"]), top.get("prices", seen["prices"]), split)]
        spark.createDataFrame(done, RUNS).coalesce(1).write.mode("append").parquet(f"{path}/runs")
        for name in ("daily", "bars"):
            drop_old(spark, f"{path}/{name}")
    finally:
        touched.unpersist()


def run_available_now(spark: SparkSession, cfg: PipelineConfig, load_id: int | None = None) -> list[StreamingQuery]:
    """Format only newly landed files (availableNow file streams with
    checkpoints), then combine what they touched (:func:`combine_touched`) and
    write documents. Returns the finished streaming queries."""
    done, schemas = [], {}
    for kind, schema in (("news", RAW_NEWS), ("prices", RAW_PRICES)):
        src = (
            spark.readStream.schema(schema)
            .json(_folder(spark, f"{cfg.landing}/kind={kind}"))
            .withColumn("_path", F.col("_metadata.file_path"))
        )
        src = _fetch_order(src) if kind == "prices" else _news_order(src)
        schemas[kind] = _landed_rows(src, kind).schema
        q = (
            src.writeStream.foreachBatch(_append_formatted(cfg.formatted, kind))
            .option("checkpointLocation", f"{cfg.checkpoint}/format_{kind}")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        done.append(q)
    combine_touched(spark, cfg, schemas, load_id)
    return done
