"""Periodic runs over a growing landing folder, and the daily tables they keep."""

import json
import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tickcast.schemas import BAR_FIELDS
from tickcast.sources.sinks import land, read_documents, stamped
from tickcast.sources.snapshots import children, drop_old, manifest, merge_snapshot, read_snapshot
from tickcast.streaming.jobs import TOUCHED, PipelineConfig, run_available_now, run_batch, touched_articles

DAY = date(2024, 1, 1)


def news_doc(symbol, days, rnd):
    feed = [{"url": f"{symbol}/{d}/{i}", "time_published": (DAY + timedelta(days=d)).strftime("%Y%m%dT120000"), "overall_sentiment_score": rnd.random(),
             "overall_sentiment_label": "Neutral", "ticker_sentiment": [{"ticker": symbol, "relevance_score": "1", "ticker_sentiment_score": str(rnd.random()),
             "ticker_sentiment_label": rnd.choice(["Bullish", "Bearish", "Neutral"])}]} for d in days for i in range(2)]
    return json.dumps({"feed": feed, "ticker": symbol})


def price_doc(symbol, days, rnd):
    series = {str(DAY + timedelta(days=d)): {k: str(rnd.uniform(1, 9)) for k, _ in BAR_FIELDS} for d in days}
    return json.dumps({"Meta Data": {"2. Symbol": symbol, "3. Last Refreshed": str(DAY + timedelta(days=max(days)))}, "Time Series (Daily)": series})


def put(spark, base, kind, rows):
    land(spark.createDataFrame(rows, "symbol string, value string"), f"{base}/landing", kind)


def config(base, name, as_of="2024-03-20"):
    return PipelineConfig(f"{base}/landing", f"{base}/{name}/formatted", f"{base}/{name}/docs", f"{base}/{name}/ckpt", as_of=as_of, now="2024-04-01 00:00:00")


def documents(spark, cfg):
    rows = read_documents(spark, cfg.documents).collect()
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


def test_a_run_reads_only_what_its_files_touch(spark, tmp_path):
    rnd, base = random.Random(5), str(tmp_path)
    cfg = config(base, "step")
    put(spark, base, "news", [(s, news_doc(s, range(0, 40), rnd)) for s in "AB"])
    put(spark, base, "prices", [(s, price_doc(s, range(0, 40), rnd)) for s in "AB"])
    run_available_now(spark, cfg, 1)
    months = manifest(spark, f"{base}/step/formatted/daily")
    first = documents(spark, cfg)
    assert months == {"2024-01": 1, "2024-02": 1}
    # one more hour: days 38 to 44 of A, overlapping prices with revised values, an article again
    put(spark, base, "news", [("A", news_doc("A", range(38, 45), rnd))])
    put(spark, base, "prices", [("A", price_doc("A", range(35, 45), rnd))])
    run_available_now(spark, cfg, 2)
    whole = config(base, "whole")
    run_batch(spark, whole, 1)
    assert documents(spark, cfg) == documents(spark, whole) and len(first) < len(documents(spark, whole))
    assert manifest(spark, f"{base}/step/formatted/daily") == {"2024-01": 1, "2024-02": 2}
    # the articles read are those of the touched days
    touched = spark.read.schema(TOUCHED).parquet(f"{base}/step/formatted/touched").filter("kind = 'news' and _batch > 0")
    rows = touched_articles(spark, spark.read.parquet(f"{base}/step/formatted/news"), touched)
    days = {str(DAY + timedelta(days=d)) for d in range(38, 45)}
    assert {r.ticker for r in rows.select("ticker").collect()} == {"A"}
    plan = rows._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    scan = next(x for x in plan.splitlines() if "PartitionFilters" in x and "day" in x)
    assert all(d in scan for d in days) and str(DAY) not in scan
    # nothing new: nothing written; another split date: all symbols again
    count = len(children(spark, f"{base}/step/formatted/runs"))
    run_available_now(spark, cfg, 3)
    assert len(children(spark, f"{base}/step/formatted/runs")) == count
    run_available_now(spark, config(base, "step", "2024-01-20"), 4)
    run_batch(spark, config(base, "early", "2024-01-20"), 1)
    early = {r[:2]: r for r in documents(spark, config(base, "early"))}
    now = {r[:2]: r for r in documents(spark, cfg)}
    assert early and all(now[k] == r for k, r in early.items())


def test_a_failed_run_is_taken_up(spark, tmp_path, monkeypatch):
    from tickcast.streaming import jobs

    rnd, base = random.Random(6), str(tmp_path)
    cfg = config(base, "step")
    put(spark, base, "news", [("A", news_doc("A", range(0, 20), rnd))])
    put(spark, base, "prices", [("A", price_doc("A", range(0, 20), rnd))])
    real = jobs.write_documents
    monkeypatch.setattr(jobs, "write_documents", lambda *a: 1 / 0)
    try:
        run_available_now(spark, cfg, 1)
        raise AssertionError("the run should have failed")
    except ZeroDivisionError:
        monkeypatch.setattr(jobs, "write_documents", real)
    run_available_now(spark, cfg, 2)
    run_batch(spark, config(base, "whole"), 1)
    assert documents(spark, cfg) == documents(spark, config(base, "whole")) != []


def test_snapshots(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, d date, o long, v string"
    rows = lambda *r: spark.createDataFrame([(k, DAY + timedelta(days=d) if d is not None else None, o, v) for k, d, o, v in r], schema)
    merge = lambda v, *r: merge_snapshot(spark, path, rows(*r), ["k", "d"], "o", F.date_format("d", "yyyy-MM"), v)
    held = lambda df: sorted(((r.k, r.v) for r in df.collect()), key=str)
    kind = rows().schema
    assert read_snapshot(spark, path, kind).count() == 0
    merge(1, (1, 0, 1, "a"), (2, 40, 1, "b"), (3, None, 1, "n"), (1, 0, 1, "a"))
    old = read_snapshot(spark, path, kind)
    merge(2, (1, 0, 2, "A"), (2, 40, 0, "older"))
    assert held(merge(2, (1, 0, 2, "A"))) == [(1, "A"), (2, "b"), (3, "n")]  # a version again replaces it
    drop_old(spark, path)
    assert held(old) == [(1, "a"), (2, "b"), (3, "n")]  # a reader of the last version goes on
    merge(3)
    merge(4, (4, 41, 1, "x"))
    drop_old(spark, path)
    assert held(read_snapshot(spark, path, kind)) == [(1, "A"), (2, "b"), (3, "n"), (4, "x")]
    assert manifest(spark, path) == {"2024-01": 2, "2024-02": 4, "none": 1} and children(spark, f"{path}/manifest") == ["v=3", "v=4"]


def event_table(spark, base):
    day = "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, id % 30)"
    kinds = "array('view', 'click', 'signup', 'error', 'purchase')"
    rows = spark.range(2000).selectExpr("id AS event_id", f"{day} AS ts", "id % 7 AS user_id", f"{kinds}[id % 5] AS event_type", "id % 90 + 0.5D AS value", "'{\"k\": 3}' AS props")
    rows.coalesce(2).write.parquet(f"{base}/events.parquet")
    return base


def test_upstream_documents_are_made_once(spark, tmp_path, monkeypatch):
    from tickcast.plans import stream_queries as Q
    from tickcast.sources import proxy

    sf, read, landed = event_table(spark, str(tmp_path)), [], []

    def land(docs, path, kind):
        read.extend(docs.inputFiles())
        landed.extend((kind, r.symbol, r.value) for r in docs.select("symbol", "value").collect())

    runs = iter(range(3))
    monkeypatch.setattr(Q, "land", land)
    monkeypatch.setattr(Q, "run_available_now", lambda spark, cfg, load_id: (read.extend(cfg.quotes.inputFiles()), next(runs) == 2 and 1 / 0))
    try:
        Q.q_periodic_runs(spark, sf)
        raise AssertionError("stopped at the last run")
    except ZeroDivisionError:
        pass
    assert read and not [f for f in read if "events.parquet" in f]
    items = lambda v: (json.loads(v)["ticker"], sorted(json.dumps(a, sort_keys=True) for a in json.loads(v)["feed"]))
    docs = [r.value for r in proxy.event_news_documents(spark, sf).collect()]
    assert sorted(map(items, docs)) == sorted(items(v) for k, _, v in landed if k == "news") and len(docs) == 50
    assert {v for k, _, v in landed if k == "prices"} == {r.value for r in proxy.event_price_documents(spark, sf).collect()}


def test_news_documents_take_one_shuffle(spark, tmp_path):
    from tickcast.sources import proxy

    docs = proxy.event_news_documents(spark, event_table(spark, str(tmp_path)))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_stamps_follow_every_ending(spark):
    stamp = '"ticker":"A","ingest_ts":"2024-01-01 00:00:00"}'
    want = {'{"a":1}': '{"a":1,' + stamp, "{}": "{" + stamp, " { } \n": " {" + stamp, '{"a":{}}\t': '{"a":{},' + stamp, '{"a":1 }': '{"a":1,' + stamp,
            "}": "," + stamp, "": "", "{": "{", "[1]": "[1]", "{ }": "{ " + stamp}
    rows = spark.createDataFrame([(v,) for v in want] + [(None,)], "value string")
    out = {r.value: r.out for r in rows.select("value", stamped(F.col("value"), F.lit("A"), "2024-01-01 00:00:00").alias("out")).collect()}
    assert out == want | {None: None}
