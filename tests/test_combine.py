from datetime import date

from pyspark.sql import functions as F

from tickcast.operators.combine import combine, latest_quotes, pair_by_symbol

PRED = "symbol string, date date, close double, prediction double"
DAILY = ("symbol string, date date, positive_news_amount long, negative_news_amount long, "
         "ticker_sentiment_score_mean double, ticker_sentiment_score_mean_label string, "
         "overall_sentiment_score_mean double, overall_sentiment_score_mean_label string")


def daily_row(sym, d, pos=1):
    return (sym, d, pos, 0, 0.1, "Neutral", 0.2, "Neutral")


def test_inner_join_and_fallback(spark):
    pred = spark.createDataFrame([
        ("A", date(2023, 5, 19), 10.0, 11.0),
        ("A", date(2023, 5, 20), None, 12.0),
        ("C", date(2023, 5, 1), 5.0, 5.5),       # prices without news: no row
    ], PRED)
    daily = spark.createDataFrame([
        daily_row("A", date(2023, 5, 19)),
        daily_row("A", date(2023, 5, 21)),       # A has matches: unmatched day dropped
        daily_row("B", date(2023, 5, 19)),       # B has no prices: fallback rows
        daily_row("B", None),                    # NULL date kept by the fallback
    ], DAILY)
    quotes = spark.createDataFrame([("A", '{"chart":{"result":[{"meta":{"regularMarketPrice": 123.5}}]}}', 1)],
                                   "symbol string, payload string, fetched_at int")
    out = combine(pred, daily, latest_quotes(quotes), now="2024-02-01 00:00:00").collect()
    got = {(r.symbol, r.date): r for r in out}
    assert set(got) == {("A", date(2023, 5, 19)), ("B", date(2023, 5, 19)), ("B", None)}
    a = got[("A", date(2023, 5, 19))]
    assert (a.close_price, a.close_price_prediction, a.current_price, a.timestamp) == (10.0, 11.0, 123.5, 1706745600000)
    b = got[("B", date(2023, 5, 19))]
    assert (b.close_price, b.close_price_prediction, b.current_price) == (0.0, 0.0, None)
    assert [c for c in combine(pred, daily).columns] == [
        "symbol", "date", "close_price", "close_price_prediction", "positive_news_amount", "negative_news_amount",
        "ticker_sentiment_score_mean", "ticker_sentiment_score_mean_label", "overall_sentiment_score_mean",
        "overall_sentiment_score_mean_label", "timestamp", "current_price"]
    streaming_like = combine(pred, daily, fallback=False, processing="timestamp").collect()
    assert {(r.symbol, r.date) for r in streaming_like} == {("A", date(2023, 5, 19))}
    assert str(dict(combine(pred, daily, processing="timestamp").dtypes)["timestamp"]) == "timestamp"


def test_no_price_feed_is_all_fallback(spark):
    daily = spark.createDataFrame([daily_row("A", date(2023, 5, 19))], DAILY)
    out = combine(None, daily).collect()
    assert len(out) == 1 and out[0].close_price == 0.0


def test_pair_by_symbol_reduces_before_join(spark):
    news = spark.createDataFrame([("A",), ("A",), ("B",)], "ticker string")
    prices = spark.createDataFrame([("A", date(2023, 5, 1)), ("C", date(2023, 5, 2))], "symbol string, date date")
    out = pair_by_symbol(news, prices).collect()
    assert [(r.symbol, r.news_rows, r.price_rows) for r in out] == [("A", 2, 1)]
