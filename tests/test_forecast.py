from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickcast.operators.forecast import (
    fit_next_close,
    predict_next_close,
    scoring_rows,
    shift_right_join,
    training_rows,
    with_next_rows,
)
from tickcast.schemas import FEATURES, PRICE_MEASURES

COLS = ["symbol", "date"] + PRICE_MEASURES
SCHEMA = "symbol string, date date, " + ", ".join(f"{m} double" for m in PRICE_MEASURES)


def bars(symbol, days, seed, constant_extras=True):
    rng = np.random.default_rng(seed)
    out = []
    for d in days:
        o = float(rng.uniform(90, 110))
        h = o + float(rng.uniform(0, 5))
        lo = o - float(rng.uniform(0, 5))
        c = float(rng.uniform(lo, h))
        vol = float(rng.uniform(1e7, 1.5e8))
        div = 0.0 if constant_extras else float(rng.choice([0.0, 0.24]))
        split = 1.0 if constant_extras else float(rng.choice([1.0, 2.0]))
        out.append((symbol, d, o, h, lo, c, c * 0.99, vol, div, split))
    return out


def trading_days(start, n):
    days, d = [], start
    while len(days) < n:
        if d.weekday() < 5:
            days.append(d)
        d += timedelta(days=1)
    return days


def test_calendar_shift_semantics(spark):
    # Thu 2023-05-18, Fri 19, Mon 22, Tue 23
    days = [date(2023, 5, 18), date(2023, 5, 19), date(2023, 5, 22), date(2023, 5, 23)]
    df = spark.createDataFrame(bars("A", days, 1), SCHEMA)
    lab = with_next_rows(df)
    scored = scoring_rows(lab, "2023-05-23").withColumn("prediction", F.col("close"))
    out = {r.date: r for r in shift_right_join(scored).collect()}
    # one row per scored day, dated the next calendar day
    assert sorted(out) == [date(2023, 5, 19), date(2023, 5, 20), date(2023, 5, 23), date(2023, 5, 24)]
    assert out[date(2023, 5, 20)].close is None            # Saturday: NULL prices
    assert out[date(2023, 5, 20)].symbol == "A"            # symbol never NULL
    assert out[date(2023, 5, 19)].close is not None        # Friday has Thursday's prediction
    assert date(2023, 5, 22) not in out                    # Monday loses its prediction
    assert date(2023, 5, 18) not in out                    # first date never predicted
    trading = {r.date for r in shift_right_join(scored, "trading").collect()}
    assert trading == {date(2023, 5, 19), date(2023, 5, 22), date(2023, 5, 23), date(2023, 5, 24)}


def test_training_rows_drop_any_null(spark):
    days = trading_days(date(2023, 1, 2), 6)
    rows = bars("A", days, 2)
    r = list(rows[1]); r[6] = None; rows[1] = tuple(r)   # NULL adjusted_close
    df = spark.createDataFrame(rows, SCHEMA)
    train = training_rows(with_next_rows(df), str(days[-1])).collect()
    got = {t.date for t in train}
    assert days[1] not in got and days[0] in got and days[-1] not in got
    assert len(got) == 4


def _ml_predictions(spark, df, as_of, features):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    lab = with_next_rows(df).select("symbol", "date", *PRICE_MEASURES, "next_day_close")
    res = {}
    for sym in [r.symbol for r in lab.select("symbol").distinct().collect()]:
        part = VectorAssembler(inputCols=features, outputCol="features").transform(lab.filter(F.col("symbol") == sym))
        model = LinearRegression(featuresCol="features", labelCol="next_day_close").fit(
            part.filter(F.col("date") < as_of).na.drop()
        )
        for r in model.transform(part.filter(F.col("date") <= as_of)).collect():
            res[(sym, r.date + timedelta(days=1))] = r.prediction
    return res


@pytest.mark.parametrize("constant_extras,tol", [(False, 1e-6), (True, 1e-3)])
def test_grouped_ols_matches_spark_ml(spark, constant_extras, tol):
    days = trading_days(date(2023, 1, 2), 60)
    rows = bars("A", days, 3, constant_extras) + bars("B", days[5:], 4, constant_extras) + bars("C", days[:40], 5, constant_extras)
    df = spark.createDataFrame(rows, SCHEMA)
    as_of = str(days[50])
    ours = {(r.symbol, r.date): r.prediction for r in predict_next_close(df, as_of).collect()}
    ml = _ml_predictions(spark, df, as_of, FEATURES)
    assert set(ours) == set(ml)
    for k, v in ml.items():
        assert ours[k] == pytest.approx(v, rel=tol, abs=tol)


def test_constant_feature_gets_zero_and_null_feature_scores_null(spark):
    days = trading_days(date(2023, 1, 2), 30)
    rows = bars("A", days, 6, constant_extras=True)
    r = list(rows[-3]); r[2] = None; rows[-3] = tuple(r)  # NULL open on a scored day
    df = spark.createDataFrame(rows, SCHEMA)
    coef = fit_next_close(with_next_rows(df), str(days[-1])).collect()[0]
    assert coef.b_dividend_amount == 0.0 and coef.b_split_coefficient == 0.0
    assert coef.n_train == 28  # 29 labelled rows before as_of, minus the one with a NULL open
    pred = {r.date: r.prediction for r in predict_next_close(df, str(days[-1])).collect()}
    assert pred[days[-3] + timedelta(days=1)] is None
    assert sum(v is not None for v in pred.values()) == len(pred) - 1


def test_constant_label_gives_mean(spark):
    days = trading_days(date(2023, 1, 2), 10)
    rows = [tuple(list(r[:5]) + [5.0] + list(r[6:])) for r in bars("A", days, 7)]
    df = spark.createDataFrame(rows, SCHEMA)
    preds = [r.prediction for r in predict_next_close(df, str(days[-1])).collect()]
    assert all(p == pytest.approx(5.0) for p in preds)


def test_symbol_without_training_rows_scores_null(spark):
    df = spark.createDataFrame(bars("A", [date(2023, 5, 19)], 8), SCHEMA)
    out = predict_next_close(df, "2023-05-19").collect()
    assert len(out) == 1 and out[0].prediction is None


def test_dedup_keeps_latest_document_row(spark):
    days = [date(2023, 5, 18), date(2023, 5, 19), date(2023, 5, 22)]
    old = [r + (1,) for r in bars("A", days, 9)]
    new = [r + (2,) for r in bars("A", days[1:], 10)]
    df = spark.createDataFrame(old + new, SCHEMA + ", fetched int")
    out = predict_next_close(df, "2023-05-22", dedup_by="fetched").collect()
    assert len(out) == 3  # one per scored day, not per duplicate
    nxt = {r.date: r.close for r in out}
    assert nxt[date(2023, 5, 19)] == new[0][5]  # Friday's row comes from the newer document
