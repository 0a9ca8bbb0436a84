from datetime import datetime

from tickcast.operators.sentiment import daily_sentiment
from tickcast.functions.scalar import sentiment_label

SCHEMA = ("time_published timestamp, ticker string, ticker_sentiment_score double, ticker_sentiment_label string, "
          "relevance_score double, overall_sentiment_score double, overall_sentiment_label string")


def test_counts_means_and_labels(spark):
    d1 = datetime(2023, 5, 19, 10)
    d2 = datetime(2023, 5, 20, 23, 59, 59)
    rows = [
        (d1, "A", 0.35, "Bullish", 1.0, 0.35, "x"),
        (d1, "A", 0.35, "Somewhat-Bullish", 1.0, 0.35, "x"),   # counts in neither
        (d1, "A", None, "Bearish", 1.0, 0.35, "x"),            # NULL score skipped by the mean
        (d2, "A", -0.35, "Bearish", 1.0, -0.5, "x"),
        (d2, "B", 0.0, "Neutral", 1.0, None, "x"),              # mean of no value: NULL → Neutral
        (None, "A", 0.9, "Bullish", 1.0, 0.9, "x"),            # NULL time: its own NULL-date group
    ]
    out = {(r.symbol, r.date and r.date.day): r for r in daily_sentiment(spark.createDataFrame(rows, SCHEMA)).collect()}
    a19 = out[("A", 19)]
    assert (a19.positive_news_amount, a19.negative_news_amount) == (1, 1)
    assert a19.ticker_sentiment_score_mean == 0.35 and a19.ticker_sentiment_score_mean_label == "Bullish"
    assert out[("A", 20)].ticker_sentiment_score_mean_label == "Bearish"  # exactly -0.35 is inclusive
    assert out[("A", 20)].overall_sentiment_score_mean_label == "Bearish"
    b = out[("B", 20)]
    assert b.overall_sentiment_score_mean is None and b.overall_sentiment_score_mean_label == "Neutral"
    assert out[("A", None)].positive_news_amount == 1


def test_label_thresholds(spark):
    df = spark.createDataFrame([(0.35,), (0.3499,), (-0.35,), (-0.3499,), (None,)], "x double")
    got = [r[0] for r in df.select(sentiment_label("x")).collect()]
    assert got == ["Bullish", "Neutral", "Bearish", "Neutral", "Neutral"]


def test_article_near_midnight_utc_stays_on_its_utc_day(spark):
    rows = [
        (datetime(2023, 5, 19, 23, 59, 59), "A", 0.5, "Bullish", 1.0, 0.5, "x"),
        (datetime(2023, 5, 20, 0, 0, 0), "A", -0.5, "Bearish", 1.0, -0.5, "x"),
    ]
    out = {r.date.day: (r.positive_news_amount, r.negative_news_amount)
           for r in daily_sentiment(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {19: (1, 0), 20: (0, 1)}


def test_published_text_parses_in_utc_whatever_the_host_zone(spark):
    from tickcast.functions.scalar import parse_published, to_utc
    from tickcast.session import ensure_session

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    ensure_session(spark)  # pins UTC again
    got = spark.createDataFrame([("20230519T235959",)], "t string").select(
        to_utc(parse_published("t")).cast("date").alias("d")).first().d
    assert got.day == 19
