import json
from datetime import date

from pyspark.sql import functions as F

from tickcast.functions.scalar import symbol_from_path
from tickcast.operators.formatting import format_news
from tickcast.schemas import NEWS
from tickcast.session import scratch_path
from tickcast.sources.documents import news_rows, read_raw_news
from tickcast.sources.sinks import land, read_documents, row_batches, to_messages, write_documents

COMBINED = ("symbol string, date date, close_price double, close_price_prediction double, "
            "positive_news_amount long, negative_news_amount long, ticker_sentiment_score_mean double, "
            "ticker_sentiment_score_mean_label string, overall_sentiment_score_mean double, "
            "overall_sentiment_score_mean_label string, timestamp long, current_price double")


def combined_row(sym, day, close, ts):
    return (sym, date(2023, 5, day), close, close, 1, 0, 0.1, "Neutral", 0.2, "Neutral", ts, None)


def test_documents_append_duplicates_upsert_keeps_latest(spark):
    first = spark.createDataFrame([combined_row("AAPL", 19, 1.0, 1), combined_row("AAPL", 20, 2.0, 1)], COMBINED)
    second = spark.createDataFrame([combined_row("AAPL", 20, 3.0, 2)], COMBINED)
    app = scratch_path(spark, "test-docs")
    write_documents(first, app)
    write_documents(first, app)
    docs = read_documents(spark, app)
    assert docs.count() == 4 and {r["index"] for r in docs.collect()} == {"aapl"}
    assert dict(docs.dtypes)["positive_news_amount"] == "int"
    up = scratch_path(spark, "test-docs")
    write_documents(first, up, mode="upsert", load_id=1)
    write_documents(second, up, mode="upsert", load_id=2)
    got = {r.date.day: r.close_price for r in read_documents(spark, up).collect()}
    assert got == {19: 1.0, 20: 3.0}


def test_messages_keep_null_fields_and_round_trip(spark):
    rows = spark.createDataFrame(
        [(None, "A", None, "Neutral", 0.5, None, None)], NEWS
    ).withColumn("time_published", F.to_timestamp(F.lit("2023-05-19 13:30:00")))
    msg = to_messages(rows, "ticker").collect()[0]
    assert msg.key == "A" and set(json.loads(msg.value)) == set(NEWS.fieldNames())
    batch = row_batches(rows.withColumn("g", F.lit(1)), ["g"], NEWS.fieldNames())
    back = news_rows(batch).collect()[0]
    assert back.ticker == "A" and back.ticker_sentiment_score is None and back.relevance_score == 0.5
    assert back.time_published.strftime("%Y-%m-%d %H:%M:%S") == "2023-05-19 13:30:00"


def test_landing_and_ticker_from_path(spark, tmp_path):
    doc = json.dumps({"feed": [{"time_published": "20230519T133000", "overall_sentiment_score": 0.1,
                                "overall_sentiment_label": "Neutral",
                                "ticker_sentiment": [{"ticker": "AAPL", "relevance_score": "1",
                                                      "ticker_sentiment_score": "0.4",
                                                      "ticker_sentiment_label": "Bullish"}]}]})
    base = scratch_path(spark, "test-landing")
    land(spark.createDataFrame([("AAPL", doc)], "symbol string, value string"), base, "news")
    raw = read_raw_news(spark, f"{base}/kind=news")
    rows = format_news(raw, ticker=symbol_from_path("_path")).collect()
    assert len(rows) == 1 and rows[0].ticker == "AAPL"
    # the reference's object names: <TICKER>_news_<time>.json
    p = tmp_path / "GOOG_news_2023-05-19T10-00-00.json"
    p.write_text(doc.replace("AAPL", "GOOG"))
    raw = read_raw_news(spark, str(p))
    assert raw.select(symbol_from_path("_path")).first()[0] == "GOOG"
    assert format_news(raw, ticker=symbol_from_path("_path")).count() == 1


def test_micro_batch_writes_are_idempotent(spark):
    from tickcast.sources.sinks import write_batch

    rows = spark.createDataFrame([combined_row("AAPL", 19, 1.0, 1), combined_row("GOOG", 19, 2.0, 1)], COMBINED)
    path = scratch_path(spark, "test-docs")
    write_documents(rows, path, batch_id=0)
    write_documents(rows, path, batch_id=0)  # the same micro-batch replayed after a failure
    write_documents(rows.filter("symbol = 'AAPL'").withColumn("close_price", F.lit(5.0)), path, batch_id=1)
    docs = read_documents(spark, path)
    # appended documents stay apart, also of one symbol and date
    assert sorted((r.symbol, r.close_price) for r in docs.collect()) == [("AAPL", 1.0), ("AAPL", 5.0), ("GOOG", 2.0)]
    newest = scratch_path(spark, "test-docs")
    for n, price in ((0, 1.0), (1, 5.0)):
        write_documents(rows.withColumn("close_price", F.lit(price)), newest, mode="upsert", load_id=7, batch_id=n)
    assert {r.close_price for r in read_documents(spark, newest).collect()} == {5.0}  # equal load ids: the later batch
    other = scratch_path(spark, "test-batch")
    write_batch(rows, other, 3)
    write_batch(rows, other, 3)
    assert spark.read.parquet(other).count() == 2


def test_documents_date_as_timestamp_option(spark):
    rows = spark.createDataFrame([combined_row("AAPL", 19, 1.0, 1)], COMBINED)
    path = scratch_path(spark, "test-docs")
    write_documents(rows, path, date_as_timestamp=True)
    assert dict(read_documents(spark, path).dtypes)["date"] == "timestamp"


def test_landing_bounds_files_per_symbol(spark):
    import glob
    import os

    docs = spark.range(200).selectExpr("CASE WHEN id % 3 = 0 THEN 'HOT' ELSE concat('S', id % 7) END AS symbol",
                                       "to_json(named_struct('feed', array(), 'ticker', 'x', 'n', id)) AS value").repartition(16)
    base = scratch_path(spark, "test-land")
    land(docs, base, "news", files_per_symbol=2)
    local = base.replace("file:", "")
    for d in glob.glob(os.path.join(local, "kind=news", "symbol=*")):
        assert len([f for f in os.listdir(d) if f.startswith("part-")]) <= 2
    assert spark.read.text(f"{base}/kind=news").count() == 200
