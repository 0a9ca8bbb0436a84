"""Properties from the test strategy: shifted right join keeps one row per
scored day; daily counts never exceed mentions; input order is irrelevant."""

import random
from datetime import date, datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickcast.operators.forecast import predict_next_close
from tickcast.operators.sentiment import daily_sentiment
from tickcast.schemas import PRICE_MEASURES

PRICE_SCHEMA = "symbol string, date date, " + ", ".join(f"{m} double" for m in PRICE_MEASURES)
NEWS_SCHEMA = ("time_published timestamp, ticker string, ticker_sentiment_score double, "
               "ticker_sentiment_label string, relevance_score double, overall_sentiment_score double, "
               "overall_sentiment_label string")

day_offsets = st.lists(st.integers(0, 60), min_size=1, max_size=25, unique=True)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.sampled_from(["A", "B", "C"]), day_offsets, min_size=1), st.integers(0, 60))
def test_right_join_keeps_one_row_per_scored_day(spark, days, cut):
    rnd = random.Random(len(days) * 100 + cut)
    start = date(2023, 1, 2)
    rows = [(s, start + timedelta(days=d), *[rnd.uniform(1, 2) for _ in PRICE_MEASURES]) for s, ds in days.items() for d in ds]
    as_of = start + timedelta(days=cut)
    out = predict_next_close(spark.createDataFrame(rows, PRICE_SCHEMA), str(as_of), persist=False).collect()
    scored = sum(1 for r in rows if r[1] <= as_of)
    assert len(out) == scored
    assert all(r.symbol is not None and r.date is not None for r in out)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 5 * 24 * 60),
                          st.sampled_from(["Bullish", "Bearish", "Neutral", "Somewhat-Bullish"]),
                          st.floats(-1, 1)), min_size=1, max_size=40))
def test_counts_bounded_and_order_irrelevant(spark, items):
    base = datetime(2023, 5, 1)
    rows = [(base + timedelta(minutes=m), t, s, lab, 1.0, s, "x") for t, m, lab, s in items]
    a = daily_sentiment(spark.createDataFrame(rows, NEWS_SCHEMA))
    b = daily_sentiment(spark.createDataFrame(list(reversed(rows)), NEWS_SCHEMA).repartition(3))
    mentions = a.sparkSession.createDataFrame(rows, NEWS_SCHEMA).groupBy(
        F.col("ticker").alias("symbol"), F.to_date("time_published").alias("date")).count()
    joined = a.join(mentions, ["symbol", "date"]).collect()
    assert all(r.positive_news_amount + r.negative_news_amount <= r["count"] for r in joined)
    cols = ["symbol", "date", "positive_news_amount", "negative_news_amount", "ticker_sentiment_score_mean_label"]
    assert sorted(a.select(*cols).collect()) == sorted(b.select(*cols).collect())
