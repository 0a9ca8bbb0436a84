"""The whole combine against a per-ticker pandas/numpy computation written
the way the reference computes it (one ticker at a time, no Spark)."""

from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from tickcast.operators.combine import combine
from tickcast.operators.forecast import predict_next_close
from tickcast.operators.sentiment import daily_sentiment
from tickcast.schemas import FEATURES, PRICE_MEASURES

AS_OF = date(2023, 3, 20)
NEWS_SCHEMA = ("time_published timestamp, ticker string, ticker_sentiment_score double, "
               "ticker_sentiment_label string, relevance_score double, overall_sentiment_score double, "
               "overall_sentiment_label string")
PRICE_SCHEMA = "symbol string, date date, " + ", ".join(f"{m} double" for m in PRICE_MEASURES)


def fixture(seed):
    rng = np.random.default_rng(seed)
    prices, news = [], []
    for sym in ["AAA", "BBB", "CCC"]:
        d = date(2023, 1, 2)
        while d <= date(2023, 3, 31):
            if d.weekday() < 5 and rng.random() > 0.05:  # trading days with a few holidays
                o = float(rng.uniform(90, 110))
                c = float(rng.uniform(90, 110))
                div = float(rng.choice([0.0, 0.0, 0.0, 0.24])) if sym == "AAA" else 0.0
                row = [sym, d, o, max(o, c) + 1, min(o, c) - 1, c, c, float(rng.uniform(1e6, 1e8)), div, 1.0]
                if rng.random() < 0.03:
                    row[6] = None  # NULL adjusted close: the row cannot train
                prices.append(tuple(row))
            d += timedelta(days=1)
    for sym in ["AAA", "BBB", "CCC", "DDD"]:  # DDD has news but no prices
        for _ in range(150):
            t = datetime(2023, 1, 1) + timedelta(minutes=int(rng.integers(0, 90 * 24 * 60)))
            s = float(np.round(rng.uniform(-1, 1), 4))
            label = "Bullish" if s >= 0.35 else "Bearish" if s <= -0.35 else "Neutral"
            news.append((t, sym, s, label, 1.0, float(np.round(rng.uniform(-1, 1), 4)), "x"))
    return prices, news


def reference_combine(prices, news):
    """Per ticker: lead(close); OLS on date < as_of without any NULL; score
    date <= as_of; date + 1 calendar day; right join; daily news; inner
    join on date; if empty, the news days with zeros."""
    p_all = pd.DataFrame(prices, columns=["symbol", "date"] + PRICE_MEASURES)
    n_all = pd.DataFrame(news, columns=["time_published", "ticker", "tss", "tsl", "rel", "oss", "osl"])
    out = []
    for sym in sorted(n_all.ticker.unique()):
        n = n_all[n_all.ticker == sym].copy()
        n["date"] = n.time_published.dt.date
        daily = n.groupby("date").agg(
            pos=("tsl", lambda s: int((s == "Bullish").sum())), neg=("tsl", lambda s: int((s == "Bearish").sum())),
            tmean=("tss", "mean"), omean=("oss", "mean")).reset_index()
        p = p_all[p_all.symbol == sym].sort_values("date").reset_index(drop=True)
        rows = []
        if len(p):
            p["y"] = p.close.shift(-1)
            train = p[(p.date < AS_OF)].dropna()
            X = train[FEATURES].to_numpy(float)
            keep = X.std(axis=0) > 0  # constant features get coefficient 0
            A = np.column_stack([np.ones(len(X)), X[:, keep]])
            beta = np.linalg.lstsq(A, train.y.to_numpy(float), rcond=None)[0]
            score = p[p.date <= AS_OF]
            pred = beta[0] + score[FEATURES].to_numpy(float)[:, keep] @ beta[1:]
            shifted = pd.DataFrame({"date": score.date + timedelta(days=1), "prediction": pred})
            joined = p.merge(shifted, on="date", how="right")
            m = joined.merge(daily, on="date", how="inner")
            rows = [(sym, r.date, r.close, r.prediction, r.pos, r.neg, r.tmean, r.omean) for r in m.itertuples()]
        if not rows:
            rows = [(sym, r.date, 0.0, 0.0, r.pos, r.neg, r.tmean, r.omean) for r in daily.itertuples()]
        out += rows
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_combine_equals_per_ticker_reference(spark, seed):
    prices, news = fixture(seed)
    pdf = spark.createDataFrame(prices, PRICE_SCHEMA)
    ndf = spark.createDataFrame(news, NEWS_SCHEMA)
    got = combine(predict_next_close(pdf, str(AS_OF)), daily_sentiment(ndf), now="2023-04-01 00:00:00").collect()
    want = reference_combine(prices, news)
    assert len(got) == len(want)
    key = lambda r: (r[0], r[1])
    got_rows = sorted(((r.symbol, r.date, r.close_price, r.close_price_prediction, r.positive_news_amount,
                        r.negative_news_amount, r.ticker_sentiment_score_mean, r.overall_sentiment_score_mean)
                       for r in got), key=key)
    for g, w in zip(got_rows, sorted(want, key=key)):
        assert g[:2] == w[:2] and g[4:6] == tuple(w[4:6])
        for a, b in zip(g[2:4] + g[6:], tuple(w[2:4]) + tuple(w[6:])):
            if b is None or (isinstance(b, float) and np.isnan(b)):
                assert a is None
            else:
                assert a == pytest.approx(b, rel=1e-7, abs=1e-7)
    assert {r.symbol for r in got if r.close_price == 0.0} == {"DDD"}
