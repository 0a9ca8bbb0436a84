import random
from datetime import date

from folds import fold_pairs
from pyspark.sql import functions as F

from tickcast.operators.formatting import format_news
from tickcast.operators.sentiment import daily_sentiment
from tickcast.session import scratch_path
from tickcast.sources import proxy
from tickcast.sources.documents import news_rows, parse_news
from tickcast.streaming.formatting import news_rows_array, route
from tickcast.streaming.pairing import pair_stream
from tickcast.streaming.jobs import daily_sentiment_stream
from tickcast.streaming.sources import FORMAT_NEWS, FORMAT_PRICES, INGEST_NEWS, INGEST_PRICES, topic_stream
from tickcast.schemas import MESSAGE

SF = "/root/testdata/sf0.001"


def test_pair_state_survives_micro_batches(spark):
    rnd = random.Random(3)
    logs = {f"S{i}": [(s, rnd.choice(["news", "prices"]), rnd.random() < 0.2) for s in range(40)] for i in range(4)}
    base = scratch_path(spark, "test-pair")
    # Four files, written one after the other, read one per trigger: the
    # two slots must carry over between micro-batches.
    for chunk in range(4):
        rows = [
            (sym, "[]" if e else '["x"]', FORMAT_NEWS if k == "news" else FORMAT_PRICES, s, None)
            for sym, msgs in logs.items() for s, k, e in msgs if s // 10 == chunk
        ]
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").json(f"{base}/in")
    src = topic_stream(spark, [FORMAT_NEWS, FORMAT_PRICES], path=f"{base}/in", max_per_trigger=1)
    q = (pair_stream(src).writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.lastProgress is not None and q.recentProgress and len([p for p in q.recentProgress if p["numInputRows"]]) == 4
    got = sorted((r.symbol, r.seq, r.news_seq, r.prices_seq) for r in spark.read.parquet(f"{base}/out").collect())
    want = sorted((sym,) + p for sym, msgs in logs.items() for p in fold_pairs(msgs))
    assert got == want


def test_in_row_formatting_equals_batch_formatting(spark):
    docs = proxy.event_news_documents(spark, SF).select(parse_news("value").alias("d"))
    batch = format_news(docs.select("d.*"))
    in_row = docs.select(F.explode(news_rows_array(F.col("d"), F.col("d.ticker"))).alias("r")).select("r.*")
    assert sorted(batch.collect()) == sorted(in_row.collect())


def test_route_quarantines_malformed(spark):
    msgs = spark.createDataFrame(
        [("A", '{"feed": []}', INGEST_NEWS, 1, None), ("A", '{"feed": [', INGEST_NEWS, 2, None),
         ("A", '{"Note": "limit"}', INGEST_NEWS, 3, None), ("A", '{"feed": [], "x": 1, "x": 2}', INGEST_NEWS, 4, None),
         ("A", '{"Meta Data": {"2. Symbol": "A"}, "Time Series (Daily)": {}}', INGEST_PRICES, 5, None),
         ("A", '{"Meta Data": {}, "Time Series (Daily)": {}}', INGEST_PRICES, 6, None), ("A", None, INGEST_PRICES, 7, None)], MESSAGE
    )
    offsets = [sorted(r.offset for r in part.collect()) for part in route(msgs)]
    assert offsets == [[1, 4], [5], [2, 3, 6, 7]]


def test_malformed_landed_documents_are_listed(spark):
    from tickcast.sources.documents import malformed_documents

    base = scratch_path(spark, "test-malformed")
    spark.createDataFrame([('{"feed": []}',), ('{"feed": [',), ('{"Note": "limit"}',)], "value string").write.text(base)
    records = sorted((r.record for r in malformed_documents(spark, base, "news").collect()), key=str)
    assert records == [None, '{"feed": [']


def test_articles_without_a_time_are_counted(spark):
    from tickcast.streaming.jobs import latest_rows, untimed_sentiment_stream, upsert_batches

    base = scratch_path(spark, "test-untimed")
    schema = ("time_published timestamp, ticker string, ticker_sentiment_score double, ticker_sentiment_label string, "
              "relevance_score double, overall_sentiment_score double, overall_sentiment_label string")
    for score in (0.5, 0.7):  # two files, read one per trigger
        rows = spark.createDataFrame([(None, "A", score, "Bullish", 1.0, 0.1, "x")], schema)
        rows.coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    q = (untimed_sentiment_stream(stream).writeStream.outputMode("update").foreachBatch(upsert_batches(f"{base}/out"))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = latest_rows(spark, f"{base}/out", ["symbol", "date"]).collect()
    want = daily_sentiment(spark.read.schema(schema).parquet(f"{base}/in")).collect()
    assert len(got) == 1 and got[0].date is None and got[0].positive_news_amount == want[0].positive_news_amount == 2


def test_stream_daily_sentiment_equals_batch(spark):
    base = scratch_path(spark, "test-daily")
    rows = proxy.event_news(spark, SF)
    msgs = rows.select(F.col("ticker").alias("key"), F.to_json(F.array(F.to_json(F.struct(*rows.columns)))).alias("value"),
                       F.lit(FORMAT_NEWS).alias("topic"), F.lit(0).cast("long").alias("offset"),
                       F.current_timestamp().alias("timestamp"))
    msgs.write.json(f"{base}/in")
    stream = news_rows(topic_stream(spark, [FORMAT_NEWS], path=f"{base}/in"))
    q = (daily_sentiment_stream(stream).writeStream.outputMode("update").format("memory")
         .queryName("daily_test").option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT * FROM daily_test")
    want = daily_sentiment(rows)
    cols = ["symbol", "date", "positive_news_amount", "negative_news_amount", "ticker_sentiment_score_mean_label"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())


def test_batch_run_equals_available_now_run(spark):
    from tickcast.operators.combine import latest_quotes
    from tickcast.sources.sinks import land, read_documents
    from tickcast.streaming.jobs import PipelineConfig, run_available_now, run_batch

    quotes = latest_quotes(proxy.quote_payloads(proxy.event_bars(spark, SF)))
    results = []
    for runner in (run_batch, run_available_now):
        base = scratch_path(spark, "test-pipeline")
        land(proxy.event_news_documents(spark, SF), f"{base}/landing", "news")
        land(proxy.event_price_documents(spark, SF), f"{base}/landing", "prices")
        cfg = PipelineConfig(f"{base}/landing", f"{base}/formatted", f"{base}/documents", f"{base}/ckpt",
                             quotes=quotes, as_of="2024-01-25", now="2024-02-01 00:00:00")
        runner(spark, cfg, 1)
        if runner is run_available_now:
            # a second periodic run with nothing new landed changes nothing
            runner(spark, cfg, 2)
        results.append(sorted(read_documents(spark, cfg.documents).collect()))
    assert results[0] == results[1] and len(results[0]) > 0


def test_pair_stream_orders_by_a_cross_topic_column(spark):
    from datetime import datetime, timedelta

    t0 = datetime(2024, 1, 1)
    # offsets restart per topic; the broker time orders across both topics
    rows = [("A", '["n"]', FORMAT_NEWS, 0, t0), ("A", '["p"]', FORMAT_PRICES, 0, t0 + timedelta(seconds=1)),
            ("A", '["n"]', FORMAT_NEWS, 1, t0 + timedelta(seconds=2)), ("A", '["p"]', FORMAT_PRICES, 1, t0 + timedelta(seconds=3))]
    base = scratch_path(spark, "test-pair-ts")
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.json(f"{base}/in")
    src = topic_stream(spark, [FORMAT_NEWS, FORMAT_PRICES], path=f"{base}/in")
    q = (pair_stream(src, seq=F.unix_micros("timestamp")).writeStream.format("memory").queryName("pairs_ts")
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.sql("SELECT count(*) FROM pairs_ts").first()[0] == 2


def test_stream_quarantine_collects_broken_payloads(spark):
    from tickcast.plans.stream_queries import _formatted

    formatted, quarantine = _formatted(spark, SF)
    broken = proxy.event_payloads(spark, SF).filter(~F.col("value").startswith('{"')).count()
    assert broken > 0 and spark.read.parquet(quarantine).count() == broken
    assert spark.read.json(formatted).filter(F.col("topic") == FORMAT_NEWS).count() > 0


def test_pipeline_counts_a_redelivered_article_once(spark):
    import json as _json

    from tickcast.sources.sinks import land, read_documents
    from tickcast.streaming.jobs import PipelineConfig, run_available_now, run_batch

    def doc(urls_scores):
        feed = [{"url": u, "time_published": "20230519T120000", "overall_sentiment_score": 0.0,
                 "overall_sentiment_label": "Neutral",
                 "ticker_sentiment": [{"ticker": "AAA", "relevance_score": "1", "ticker_sentiment_score": sc,
                                       "ticker_sentiment_label": "Bullish"}] * n}
                for u, sc, n in urls_scores]
        return _json.dumps({"feed": feed, "ticker": "AAA"} if own_ticker else {"feed": feed})

    prices = {"Meta Data": {"2. Symbol": "AAA", "3. Last Refreshed": "2023-05-19"},
              "Time Series (Daily)": {d: {"1. open": "1", "2. high": "1", "3. low": "1", "4. close": c,
                                          "5. adjusted close": c, "6. volume": "1", "7. dividend amount": "0",
                                          "8. split coefficient": "1"}
                                      for d, c in [("2023-05-17", "1"), ("2023-05-18", "2"), ("2023-05-19", "3")]}}
    for runner, own_ticker in ((run_batch, True), (run_batch, False), (run_available_now, False)):
        base = scratch_path(spark, "test-redelivery")
        # hour 1: article u1; hour 2: u1 again (re-delivered) and u2 naming the ticker twice
        land(spark.createDataFrame([("AAA", doc([("u1", "0.5", 1)]))], "symbol string, value string"), f"{base}/landing", "news")
        land(spark.createDataFrame([("AAA", doc([("u1", "0.5", 1), ("u2", "0.7", 2)]))], "symbol string, value string"),
             f"{base}/landing", "news")
        land(spark.createDataFrame([("AAA", _json.dumps(prices))], "symbol string, value string"), f"{base}/landing", "prices")
        cfg = PipelineConfig(f"{base}/landing", f"{base}/formatted", f"{base}/documents", f"{base}/ckpt",
                             as_of="2023-05-19", now="2023-05-20 00:00:00")
        runner(spark, cfg, 1)
        row = [r for r in read_documents(spark, cfg.documents).collect() if r.date == date(2023, 5, 19)]
        assert len(row) == 1 and row[0].positive_news_amount == 3  # u1 once, u2's two mentions


def test_daily_windows_close_with_the_watermark_in_append_mode(spark):
    from datetime import datetime as dt

    rows1 = [(dt(2024, 1, d, 12), "A", 0.5, "Bullish", 1.0, 0.1, "x") for d in (1, 2, 3)]
    rows2 = [(dt(2024, 1, 10, 12), "A", -0.5, "Bearish", 1.0, 0.1, "x")]
    base = scratch_path(spark, "test-append")
    schema = ("time_published timestamp, ticker string, ticker_sentiment_score double, ticker_sentiment_label string, "
              "relevance_score double, overall_sentiment_score double, overall_sentiment_label string")
    for rows in (rows1, rows2):  # two files, read one per trigger
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    q = (daily_sentiment_stream(stream, watermark="1 day").writeStream.outputMode("append").format("memory")
         .queryName("daily_append").option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    days = sorted(r.date.day for r in spark.sql("SELECT * FROM daily_append").collect())
    # days 1-3 are final once day 10 moved the watermark; day 10 is still open
    assert days == [1, 2, 3]
