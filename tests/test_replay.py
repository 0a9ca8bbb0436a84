"""Quotes as of a row's time, stamps of landed documents, reasons of rejection."""

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tickcast.operators.combine import latest_quotes, quotes_as_of
from tickcast.sources.documents import malformed_documents, read_raw_news, read_stamps, rejection
from tickcast.sources.sinks import land

T0 = datetime(2024, 1, 1)


def test_quotes_as_of_equals_a_plain_scan(spark):
    rnd = random.Random(1)
    rows = [(i, f"s{i % 3}", T0 + timedelta(hours=rnd.randrange(400))) for i in range(200)] + [(900, "s0", None), (901, "none", T0), (902, None, T0)]
    quotes = [(f"s{rnd.randrange(2)}", T0 + timedelta(hours=rnd.randrange(40, 400)), float(rnd.randrange(50))) for _ in range(60)]
    quotes += [("s0", quotes[0][1], 99.0), ("s0", None, 1.0), ("s1", T0, None), (None, T0, 7.0)]
    df = spark.createDataFrame(rows, "id int, symbol string, at timestamp").withColumn("_price", F.lit("own"))
    q = spark.createDataFrame(quotes, "symbol string, fetched_at timestamp, price double")

    def want(symbol, at):
        known = [(t, p) for s, t, p in quotes if s == symbol and t is not None and p is not None and at is not None and t <= at]
        return max(known)[1] if known else None

    for chunk in (3600, 86400, 10**8):
        got = quotes_as_of(df, q, "at", chunk=chunk)
        assert got.columns == [*df.columns, "current_price"]
        assert {r.id: r.current_price for r in got.collect()} == {i: want(s, t) for i, s, t in rows}
    assert quotes_as_of(df.limit(0), q, "at").count() == 0


def test_a_replay_takes_no_later_quote(spark):
    payload = '{"chart":{"result":[{"meta":{"regularMarketPrice":%s}}]}}'
    q = spark.createDataFrame([("A", T0, payload % 1.5), ("A", T0 + timedelta(days=2), payload % 2.5)], "symbol string, fetched_at timestamp, payload string")
    price = lambda **k: [r.current_price for r in latest_quotes(q, **k).collect()]
    assert price() == [2.5] and price(as_of="2024-01-02 00:00:00") == [1.5] and price(as_of="2023-01-01 00:00:00") == []


def test_stamps(spark, tmp_path):
    texts = ['{"feed":[]}', "{}", '{"ticker":"other","items":"1"} ', '{"feed":[', "plain", None]
    docs = spark.createDataFrame([(f'Q"{i}', t) for i, t in enumerate(texts)], "symbol string, value string").filter("value is not null")
    land(docs, str(tmp_path / "x"), "news", ingested_at="2024-02-01 10:00:00")
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "x" / "kind=news")).collect())
    whole = [json.loads(x) for x in lines if x.endswith("}")]
    assert [x["ticker"] for x in whole] and {x["ingest_ts"] for x in whole} == {"2024-02-01 10:00:00"} and {"plain", '{"feed":['} <= set(lines)
    assert len(whole) == 3 and '{"ticker":"other"' in "".join(lines)
    got = {r.ticker: str(r.ingest_ts) for r in read_stamps(spark, str(tmp_path / "x" / "kind=news")).filter("ticker is not null").collect()}
    assert got == {f'Q"{i}': "2024-02-01 10:00:00" for i in range(3)}
    assert {r.ticker for r in read_raw_news(spark, str(tmp_path / "x" / "kind=news")).filter("ticker is not null").collect()} == set(got)
    bad = malformed_documents(spark, str(tmp_path / "x" / "kind=news"), "news")
    assert sorted(r.reason for r in bad.collect()) == ["broken", "broken", "no feed", "no feed"]


def test_reasons(spark):
    meta, series = '"Meta Data":{"2. Symbol":"A"}', '"Time Series (Daily)":{}'
    values = ["{%s,%s}" % (meta, series), "{%s}" % meta, '{"Meta Data":{},%s}' % series, "{", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    got = [r.w for r in df.select("i", rejection(F.col("value"), "prices").alias("w")).orderBy("i").collect()]
    assert got == [None, "no series", "no symbol", "broken", "broken"]
