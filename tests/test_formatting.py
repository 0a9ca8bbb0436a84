import json
from datetime import datetime

from pyspark.sql import functions as F

from tickcast.operators.formatting import format_news, format_prices, latest_bars
from tickcast.schemas import RAW_NEWS
from tickcast.sources.documents import parse_news, parse_prices, read_raw_prices


def mention(t, score="0.5", label="Bullish", rel="0.9"):
    return {"ticker": t, "relevance_score": rel, "ticker_sentiment_score": score, "ticker_sentiment_label": label}


def article(ts, mentions, overall=0.1, label="Neutral"):
    return {
        "title": "t", "url": "u", "time_published": ts, "authors": ["a"], "summary": None,
        "banner_image": None, "source": "s", "category_within_source": "c", "source_domain": "d",
        "topics": [{"relevance_score": "1.0", "topic": "x"}], "overall_sentiment_score": overall,
        "overall_sentiment_label": label, "ticker_sentiment": mentions,
    }


def news_doc(ticker, feed):
    return json.dumps({"items": str(len(feed or [])), "sentiment_score_definition": "", "relevance_score_definition": "", "feed": feed, "ticker": ticker})


def test_format_news_filters_explodes_and_parses(spark):
    docs = [
        news_doc("AAPL", [
            article("20230519T133000", [mention("AAPL"), mention("GOOG", "-0.5", "Bearish")]),
            article("20230519T235959", []),                      # no mention: no row
            article("20230520T000001", None),                    # NULL mention list: no row
            article("bad-time", [mention("AAPL", "oops", "Neutral")]),  # malformed: NULLs, kept
            article("20230521T101010", [mention("AAPL", "0.2"), mention("AAPL", "0.4")]),  # twice: two rows
        ]),
        news_doc("GOOG", [article("20230519T133000", [mention("AAPL"), mention("GOOG", "-0.5", "Bearish")])]),
        news_doc("MSFT", None),                                   # NULL feed: no row
        news_doc("MSFT", []),                                     # empty feed: no row
    ]
    raw = spark.createDataFrame([(d,) for d in docs], "value string").select(parse_news("value").alias("d")).select("d.*")
    out = format_news(raw).orderBy("ticker", "time_published", "ticker_sentiment_score").collect()
    assert [r.ticker for r in out] == ["AAPL", "AAPL", "AAPL", "AAPL", "GOOG"]
    by_score = {(r.ticker, r.ticker_sentiment_score) for r in out}
    assert ("AAPL", 0.5) in by_score and ("GOOG", -0.5) in by_score
    bad = [r for r in out if r.time_published is None]
    assert len(bad) == 1 and bad[0].ticker_sentiment_score is None
    good = [r for r in out if r.time_published is not None and r.ticker == "AAPL"]
    assert datetime(2023, 5, 19, 13, 30) in [r.time_published for r in good]
    assert sorted(r.ticker_sentiment_score for r in good if r.time_published.day == 21) == [0.2, 0.4]
    assert {c for c, _ in format_news(raw).dtypes} == {
        "time_published", "ticker", "ticker_sentiment_score", "ticker_sentiment_label",
        "relevance_score", "overall_sentiment_score", "overall_sentiment_label"}


def test_format_news_ticker_from_another_column(spark):
    raw = spark.createDataFrame(
        [(news_doc(None, [article("20230519T133000", [mention("AAPL")])]), "AAPL")], "value string, sym string"
    ).select(parse_news("value").alias("d"), "sym").select("d.*", "sym")
    assert format_news(raw, ticker="sym").count() == 1
    assert format_news(raw).count() == 0  # a NULL document ticker matches nothing


def price_doc(symbol, days):
    series = {d: {"1. open": o, "2. high": "2", "3. low": "0.5", "4. close": c, "5. adjusted close": c,
                  "6. volume": "100", "7. dividend amount": "0.0000", "8. split coefficient": "1.0"}
              for d, o, c in days}
    return json.dumps({"Meta Data": {"1. Information": "x", "2. Symbol": symbol, "3. Last Refreshed": max(d for d, _, _ in days),
                                     "4. Output Size": "Compact", "5. Time Zone": "US/Eastern"},
                       "Time Series (Daily)": series})


def test_format_prices_map_of_days(spark):
    docs = [price_doc("AAPL", [("2023-05-19", "1.5", "1.75"), ("2023-05-18", "bad", "1.0")]),
            price_doc("GOOG", [("2023-05-19", "3", "4"), ("2023-05-17", "3", "4"), ("2023-05-16", "3", "4")])]
    raw = spark.createDataFrame([(d,) for d in docs], "value string").select(parse_prices("value").alias("d")).select("d.*")
    out = format_prices(raw).orderBy("symbol", "date").collect()
    assert [(r.symbol, r.date.strftime("%Y-%m-%d")) for r in out][:2] == [("AAPL", "2023-05-18"), ("AAPL", "2023-05-19")]
    assert len(out) == 5
    assert out[0].open is None and out[0].close == 1.0
    assert out[1].open == 1.5 and out[1].volume == 100.0


def test_pretty_printed_price_file_needs_multiline(spark, tmp_path):
    p = tmp_path / "AAPL_prices_2023-05-19T10-00-00.json"
    p.write_text(json.dumps(json.loads(price_doc("AAPL", [("2023-05-19", "1", "2")])), indent=4))
    raw = read_raw_prices(spark, str(p), multiline=True)
    rows = format_prices(raw).collect()
    assert len(rows) == 1 and rows[0].symbol == "AAPL" and rows[0].close == 2.0
    flat = read_raw_prices(spark, str(p), multiline=False)
    assert format_prices(flat).count() == 0


def test_latest_bars_keeps_latest_document(spark):
    df = spark.createDataFrame(
        [("A", "2023-05-19", 1.0, 1), ("A", "2023-05-19", 2.0, 2), ("A", "2023-05-18", 3.0, 1)],
        "symbol string, date string, close double, fetched int",
    ).withColumn("date", F.to_date("date"))
    out = {r.date.day: r.close for r in latest_bars(df, "fetched").collect()}
    assert out == {19: 2.0, 18: 3.0}


def test_schema_declares_raw_news():
    assert [f.name for f in RAW_NEWS.fields] == ["items", "sentiment_score_definition", "relevance_score_definition", "feed", "ticker"]
