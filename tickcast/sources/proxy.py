"""Stand-in inputs derived from the given test tables.

The test tables hold no stocks, so two mappings turn them into the shapes the
pipeline consumes (news mentions, daily bars, raw documents, messages). Every
frame here is a plain Spark plan over the tables, so its work grows with them.

events  → 5 symbols ``'S' || user_id % 5``; purchases make bars, the other
          event types make articles.
orders  → symbol = customer market segment; lineitem ⋈ orders ⋈ customer make
          bars by ship date, orders ⋈ customer make articles by order date.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.functions.scalar import PUBLISHED_FORMAT, row_json
from tickcast.schemas import BAR_FIELDS, META_KEYS

# Order priority → article label in the orders mapping.
PRIORITY_LABELS = {
    "1-URGENT": "Bullish",
    "2-HIGH": "Somewhat-Bullish",
    "3-MEDIUM": "Neutral",
    "4-NOT SPECIFIED": "Somewhat-Bearish",
    "5-LOW": "Bearish",
}

# Event types that become articles; "error" events become articles without
# any ticker mention (dropped by formatting), "purchase" events become bars.
ARTICLE_TYPES = ["view", "click", "signup"]
EMPTY_MENTION_TYPE = "error"
BAR_TYPE = "purchase"
N_EVENT_SYMBOLS = 5
ITEMS_PER_DOCUMENT = 200  # the upstream request limit per news fetch
BYTES_PER_PARTITION = 4 << 20  # of the events table: about 100 MB of news documents
EVENTS_PER_FETCH = 1000  # event ids between two price fetches of a symbol
DAYS_PER_FETCH = 100  # the upstream "compact" history of a price document
FIRST_FETCH = "2024-01-11"  # ten days of history: the model has more rows than features


# Declared schemas of the test tables this module reads (no inference job).
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def article_label(score: Column) -> Column:
    """The upstream five-level article scale. thresholds
    -0.35, -0.15, 0.15, 0.35 and the five label names."""
    return (
        F.when(score <= -0.35, "Bearish")
        .when(score <= -0.15, "Somewhat-Bearish")
        .when(score < 0.15, "Neutral")
        .when(score < 0.35, "Somewhat-Bullish")
        .when(score.isNotNull(), "Bullish")
    )


def _event_symbol(offset: int = 0) -> Column:
    return F.concat(
        F.lit("S"), ((F.col("user_id") + F.lit(offset)) % N_EVENT_SYMBOLS).cast("string")
    )


def _bars(rows: DataFrame, day: Column, price: Column, volume: Column, order_key: Column) -> DataFrame:
    """Daily bars: open/close are the first/last price by a unique order
    key (no ties), adjusted close = close, no dividends or splits."""
    agg = rows.groupBy("symbol", day.alias("date")).agg(
        F.min_by(price, order_key).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order_key).alias("close"),
        F.sum(volume).alias("volume"),
    )
    return agg.select(
        "symbol", "date", "open", "high", "low", "close",
        F.col("close").alias("adjusted_close"), "volume",
        F.lit(0.0).alias("dividend_amount"), F.lit(1.0).alias("split_coefficient"),
    )


# --------------------------------------------------------------------- events
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("symbol", _event_symbol())


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars (symbol, date, 8 measures) from purchase events."""
    ev = events(spark, sf_dir).filter(F.col("event_type") == BAR_TYPE)
    return _bars(ev, F.to_date("ts"), F.col("value"), F.col("value"), F.col("event_id"))


def _event_scores(ev: DataFrame, *keep: str) -> DataFrame:
    return ev.select(
        *keep,
        "event_id",
        "event_type",
        "symbol",
        _event_symbol(1).alias("other_symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        ((F.col("value") - F.lit(50.0)) / F.lit(100.0)).alias("ticker_score"),
        ((F.col("value") - F.lit(40.0)) / F.lit(100.0)).alias("overall_score"),
        (F.get_json_object("props", "$.k").cast("double") / F.lit(100.0)).alias("relevance"),
    )


def event_news(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """Formatted news rows (the ``NEWS`` layer) straight from events;
    ``with_id`` keeps ``event_id`` (a unique article key)."""
    ev = _event_scores(events(spark, sf_dir).filter(F.col("event_type").isin(ARTICLE_TYPES)))
    return ev.select(
        *(["event_id"] if with_id else []),
        F.date_trunc("second", "ts").alias("time_published"),
        F.col("symbol").alias("ticker"),
        F.col("ticker_score").alias("ticker_sentiment_score"),
        article_label(F.col("ticker_score")).alias("ticker_sentiment_label"),
        F.col("relevance").alias("relevance_score"),
        F.col("overall_score").alias("overall_sentiment_score"),
        article_label(F.col("overall_score")).alias("overall_sentiment_label"),
    )


def _article(symbol: Column, e: Column) -> Column:
    """The article struct of a non-purchase event, with its mention list; ``e``
    holds the event's scores (:func:`_event_scores`), ``symbol`` is its own."""

    def mention(ticker: Column, score: Column, relevance: Column) -> Column:
        return F.struct(
            ticker.alias("ticker"),
            relevance.cast("string").alias("relevance_score"),
            score.cast("string").alias("ticker_sentiment_score"),
            article_label(score).alias("ticker_sentiment_label"),
        )

    own = mention(symbol, e["ticker_score"], e["relevance"])
    other = mention(e["other_symbol"], -e["ticker_score"], F.lit(0.1))
    mentions = (
        F.when(e["event_type"] == EMPTY_MENTION_TYPE, F.array().cast("array<struct<ticker:string,relevance_score:string,ticker_sentiment_score:string,ticker_sentiment_label:string>>"))
        .when(e["event_type"] == "signup", F.array(own))
        .otherwise(F.array(own, other))
    )
    return F.struct(
        e["event_type"].alias("title"),
        F.concat(F.lit("event/"), e["event_id"].cast("string")).alias("url"),
        F.date_format(e["ts"], PUBLISHED_FORMAT).alias("time_published"),
        F.array(e["event_type"]).alias("authors"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("banner_image"),
        F.lit("events").alias("source"),
        e["event_type"].alias("category_within_source"),
        F.lit("events").alias("source_domain"),
        F.array(
            F.struct(
                e["relevance"].cast("string").alias("relevance_score"),
                e["event_type"].alias("topic"),
            )
        ).alias("topics"),
        e["overall_score"].alias("overall_sentiment_score"),
        article_label(e["overall_score"]).alias("overall_sentiment_label"),
        mentions.alias("ticker_sentiment"),
    )


def _partitions(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Shuffle partitions for rows that grow into documents: they follow the
    table's size on disk, so a task's share of the text does not grow with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    return max(spark.sparkContext.defaultParallelism, -(-size // BYTES_PER_PARTITION))


def event_news_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw news documents, one per (symbol, block of ≤200 event ids) — the
    upstream per-fetch limit — as (symbol, fetched_at, value JSON)."""
    # Collecting a list does not shrink anything map-side, so the narrow raw
    # event rows are shuffled by document key, once, and collected as they are;
    # the article structs are built inside the finished documents.
    ev = (
        events(spark, sf_dir)
        .filter(F.col("event_type") != BAR_TYPE)
        .withColumn("block", F.floor(F.col("event_id") / F.lit(ITEMS_PER_DOCUMENT)))
        .repartition(_partitions(spark, sf_dir, "events"), "symbol", "block")
    )
    scores = _event_scores(ev, "block")
    event = F.struct(*[c for c in scores.columns if c not in ("symbol", "block")])
    docs = scores.groupBy("symbol", "block").agg(
        F.collect_list(event).alias("events"),
        F.max("ts").alias("fetched_at"),
        F.max("event_id").alias("seq"),
    )
    doc = F.struct(
        F.size("events").cast("string").alias("items"),
        F.lit("x <= -0.35: Bearish; x >= 0.35: Bullish").alias("sentiment_score_definition"),
        F.lit("0 < x <= 1").alias("relevance_score_definition"),
        F.transform("events", lambda e: _article(F.col("symbol"), e)).alias("feed"),
        F.col("symbol").alias("ticker"),
    )
    return docs.select(
        "symbol", "block", "fetched_at", "seq", F.to_json(doc).alias("value")
    )


def event_price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw price documents, one per (symbol, month) of bars, as JSON text.
    Values are strings, the series is an object keyed by date. ``seq`` is
    the last purchase event id of the month (the document's arrival)."""
    docs = price_documents(event_bars(spark, sf_dir))
    last = (
        events(spark, sf_dir)
        .filter(F.col("event_type") == BAR_TYPE)
        .groupBy("symbol", F.date_trunc("month", F.to_date("ts")).cast("date").alias("month"))
        .agg(F.max("event_id").alias("seq"))
    )
    return docs.join(last, ["symbol", "month"], "left")


def event_price_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping price documents, as repeated fetches return them: one per
    (symbol, block of event ids) with the bars of the DAYS_PER_FETCH days
    before the fetch. ``seq`` is the block's last purchase event id."""
    fetches = (
        events(spark, sf_dir)
        .filter(F.col("event_type") == BAR_TYPE)
        .groupBy("symbol", F.floor(F.col("event_id") / F.lit(EVENTS_PER_FETCH)).alias("block"))
        .agg(F.max("event_id").alias("seq"), F.max(F.to_date("ts")).alias("day"))
        .filter(F.col("day") >= F.lit(FIRST_FETCH).cast("date"))
    )
    # one row per fetch and day back, so the bars join on (symbol, date)
    back = F.explode(F.sequence(F.date_sub("day", DAYS_PER_FETCH), F.date_sub("day", 1)))
    days = fetches.select("symbol", "seq", back.alias("date"))
    return price_documents(days.join(event_bars(spark, sf_dir), ["symbol", "date"]), "seq")


def price_documents(bars: DataFrame, part: str | None = None) -> DataFrame:
    """Bars → (symbol, part, last_refreshed, value) price documents; the
    default part is the month."""
    if part is None:
        part, bars = "month", bars.withColumn("month", F.date_trunc("month", F.col("date")).cast("date"))
    values = F.struct(
        *[F.col(name).cast("string").alias(src) for src, name in BAR_FIELDS]
    )
    entries = bars.select(
        "symbol",
        part,
        F.col("date"),
        F.struct(F.date_format("date", "yyyy-MM-dd").alias("k"), values.alias("v")).alias("e"),
    )
    docs = entries.groupBy("symbol", part).agg(
        F.map_from_entries(F.collect_list("e")).alias("series"),
        F.max("date").alias("last_refreshed"),
    )
    meta = F.create_map(
        F.lit(META_KEYS[0]), F.lit("Daily Time Series with Splits and Dividend Events"),
        F.lit(META_KEYS[1]), F.col("symbol"),
        F.lit(META_KEYS[2]), F.date_format("last_refreshed", "yyyy-MM-dd"),
        F.lit(META_KEYS[3]), F.lit("Compact"),
        F.lit(META_KEYS[4]), F.lit("US/Eastern"),
    )
    doc = F.struct(meta.alias("Meta Data"), F.col("series").alias("Time Series (Daily)"))
    return docs.select("symbol", part, "last_refreshed", F.to_json(doc).alias("value"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-symbol message log in the formatted-topic shape (a JSON array of
    JSON-row texts): one message per event, kind prices for purchases and
    news otherwise, in event-id order. Error events are empty news messages
    (``[]``), which clear the news slot of the pair-and-reset operator."""
    ev = events(spark, sf_dir)
    row = row_json("event_id", "event_type", "value")
    value = F.when(F.col("event_type") == EMPTY_MENTION_TYPE, F.lit("[]")).otherwise(
        F.to_json(F.array(row))
    )
    return ev.select(
        "symbol",
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == BAR_TYPE, F.lit("prices")).otherwise(F.lit("news")).alias("kind"),
        value.alias("value"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw message per event; error events carry a broken payload (an
    unbalanced brace)."""
    ev = events(spark, sf_dir)
    body = row_json("event_id", "event_type", "value")
    value = F.when(F.col("event_type") == EMPTY_MENTION_TYPE, F.concat(F.lit("{"), body)).otherwise(body)
    return ev.select("symbol", F.col("event_id").alias("seq"), value.alias("value"))


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw message per event for the quarantine: purchases are price
    documents (of four, one lacks the series and one the symbol), the others
    news (signups lack the feed, error events are an unbalanced brace)."""
    ev = events(spark, sf_dir)
    is_price = F.col("event_type") == "purchase"
    four = F.col("event_id") % 4
    meta, series = F.concat(F.lit('"Meta Data":{"2. Symbol":"'), "symbol", F.lit('"}')), F.lit('"Time Series (Daily)":{"2024-01-01":{"1. open":"1"}}')
    price = F.when(four == 0, F.concat(F.lit("{"), meta, F.lit("}"))).when(four == 1, F.concat(F.lit('{"Meta Data":{},'), series, F.lit("}")))
    price = price.otherwise(F.concat(F.lit("{"), meta, F.lit(","), series, F.lit("}")))
    news = F.when(F.col("event_type") == "signup", F.lit('{"items":"0"}')).otherwise(F.lit('{"items":"0","feed":[]}'))
    news = F.when(F.col("event_type") == EMPTY_MENTION_TYPE, F.concat(F.lit("{"), news)).otherwise(news)
    topic = F.when(is_price, F.lit("ingest_prices_topic")).otherwise(F.lit("ingest_news_topic"))
    return ev.select("symbol", F.col("event_id").alias("seq"), topic.alias("topic"), F.when(is_price, price).otherwise(news).alias("value"))


def event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, fetched_at, price): every purchase is a quote."""
    ev = events(spark, sf_dir).filter("event_type = 'purchase'")
    return ev.select("symbol", F.col("ts").cast("timestamp").alias("fetched_at"), F.col("value").alias("price"))


# --------------------------------------------------------------------- orders
def segment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("symbol"), "c_acctbal"
    )
    return orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")


def line_order_key() -> Column:
    """One decimal in the order of a line's four keys (13, 3, 11 and 11
    digits): a fixed-width buffer, which a hash aggregate can hold."""
    key = F.col("l_orderkey").cast("decimal(38,0)")
    for name, digits in (("l_linenumber", 3), ("l_partkey", 11), ("l_suppkey", 11)):
        key = key * F.lit(Decimal(10**digits)) + F.col(name)
    return key


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per supplier from lineitem: the number of symbols grows
    with the table."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_shipdate",
    )
    rows = li.withColumn("symbol", F.concat(F.lit("P"), F.col("l_suppkey").cast("string")))
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return _bars(rows, F.to_date("l_shipdate"), unit, F.col("l_quantity"), line_order_key())


def order_bars(spark: SparkSession, sf_dir: str, seg: DataFrame | None = None) -> DataFrame:
    """Daily bars per market segment from lineitem ⋈ orders ⋈ customer."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_shipdate",
    )
    seg = (seg if seg is not None else segment_orders(spark, sf_dir)).select("o_orderkey", "symbol")
    # Fact-to-fact join on the order key: a sort-merge join (what the planner
    # picks once orders outgrow the broadcast threshold) spreads the
    # per-line aggregation over all shuffle partitions, independent of how
    # many splits the lineitem files have. Never a forced broadcast.
    rows = li.join(seg.hint("merge"), li.l_orderkey == seg.o_orderkey, "inner")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return _bars(rows, F.to_date("l_shipdate"), unit, F.col("l_quantity"), line_order_key())


def order_news(spark: SparkSession, sf_dir: str, seg: DataFrame | None = None) -> DataFrame:
    """Formatted news rows per market segment from orders ⋈ customer."""
    o = seg if seg is not None else segment_orders(spark, sf_dir)
    label = F.coalesce(
        *[F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in PRIORITY_LABELS.items()]
    )
    overall = F.col("c_acctbal") / F.lit(10000.0)
    return o.select(
        F.col("o_orderdate").cast("timestamp").alias("time_published"),
        F.col("symbol").alias("ticker"),
        ((F.col("o_totalprice") - F.lit(250000.0)) / F.lit(250000.0)).alias("ticker_sentiment_score"),
        label.alias("ticker_sentiment_label"),
        F.lit(1.0).alias("relevance_score"),
        overall.alias("overall_sentiment_score"),
        article_label(overall).alias("overall_sentiment_label"),
    )


def quote_payloads(bars: DataFrame) -> DataFrame:
    """Landed quote payloads: the last close of each symbol as the current
    price, in the upstream payload shape (symbol, fetched_at, payload)."""
    last = bars.groupBy("symbol").agg(
        F.max_by("close", "date").alias("price"), F.max("date").alias("fetched_at")
    )
    payload = F.to_json(
        F.struct(
            F.struct(
                F.array(F.struct(F.struct(F.col("price").alias("regularMarketPrice")).alias("meta"))).alias("result")
            ).alias("chart")
        )
    )
    return last.select("symbol", "fetched_at", payload.alias("payload"))
