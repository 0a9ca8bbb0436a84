"""Messages put in order ahead of pairing; newest news kept on the stream."""

import random
from datetime import datetime, timedelta

from folds import fold_pairs
from pyspark.sql import functions as F

from tickcast.operators.recent import recent_news
from tickcast.schemas import MESSAGE
from tickcast.sources.sinks import write_batch
from tickcast.sources.snapshots import children
from tickcast.streaming.pairing import pair_batches
from tickcast.streaming.recent import read_recent, recent_sink
from tickcast.streaming.reorder import TIME_CHUNK, broker_order, flush, reorder_batches
from tickcast.streaming.sources import FORMAT_NEWS, FORMAT_PRICES

T0 = datetime(2024, 1, 1)


def test_shuffled_messages_pair_as_in_order(spark, tmp_path):
    rnd = random.Random(8)
    topics = {"news": FORMAT_NEWS, "prices": FORMAT_PRICES}
    log = [(rnd.choice(["hot", "hot", "A"]), rnd.choice(["news", "prices"]), rnd.random() < 0.2, i) for i in range(60)]
    rows = [(s, "[]" if e else f'["{i}"]', topics[k], i, T0 + timedelta(seconds=i)) for s, k, e, i in log]
    want = sorted((s, *p) for s in ("hot", "A") for p in fold_pairs([(i, k, e) for t, k, e, i in log if t == s]))
    shuffled = sorted(rows, key=lambda r: r[3] + rnd.randrange(9))
    cuts = [0, 13, 13, 30, 60]

    def run(name, order):
        base = str(tmp_path / name)
        pairs = pair_batches(f"{base}/slots", lambda df, n: write_batch(df.drop("news_value", "prices_value"), f"{base}/pairs", n))
        write = reorder_batches(f"{base}/buffer", pairs, "10 seconds") if order else pairs
        for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
            for _ in range(1 + (n == 2)):  # a micro-batch that runs again
                write(spark.createDataFrame(shuffled[low:high], MESSAGE), n)
        if order:
            assert flush(spark, f"{base}/buffer", pairs) and not flush(spark, f"{base}/buffer", pairs)
            assert len(children(spark, f"{base}/buffer/held")) <= 2
        return sorted((r.symbol, r.seq, r.news_seq, r.prices_seq) for r in spark.read.parquet(f"{base}/pairs").collect())

    assert run("ordered", True) == want != run("plain", False)


def test_the_stream_goes_on_after_a_flush(spark, tmp_path):
    base, got = str(tmp_path), {}
    sink = lambda df, n: got.update({n: sorted(r.value for r in df.collect())})
    write = reorder_batches(base, sink, "10 seconds")
    at = lambda v, s, key="A": (key, v, "t", 0, None if s is None else T0 + timedelta(seconds=s))
    put = lambda n, *rows: write(spark.createDataFrame(rows, MESSAGE), n)
    put(0)
    put(1, at("a", 0), at("untimed", None), at("nobody", 0, None))
    assert got == {0: [], 2: ["untimed"]}
    put(2, at("b", 10))  # "a" is due: exactly as late as is waited for
    assert got[4] == ["a", "nobody"]
    flush(spark, base, sink)
    assert got[5] == ["b"]
    put(3, at("late", 0), at("c", 12))
    put(3, at("late", 0), at("c", 12))
    assert got[6] == ["late"]
    put(4, at("d", 22))
    assert got[8] == ["c"] and sorted(got) == [0, 2, 4, 5, 6, 8]


def test_broker_order(spark):
    rows = [("A", None, t, o, T0 + timedelta(milliseconds=m)) for t, o, m in
            [(FORMAT_NEWS, 7, 0), (FORMAT_NEWS, 1 << 40, 0), (FORMAT_PRICES, 3, 0), (FORMAT_PRICES, 4, 0), (FORMAT_NEWS, 9, 1), (FORMAT_PRICES, 2, 1)]]
    df = spark.createDataFrame(rows, MESSAGE).withColumn("n", broker_order())
    got = [(r.topic, r.offset) for r in df.orderBy("n").collect()]
    assert got == [(FORMAT_NEWS, 1 << 40), *[r[2:4] for r in [rows[0], *rows[2:]]]]
    assert df.select("n").distinct().count() == 6 and df.agg(F.min("n")).first()[0] > TIME_CHUNK


def test_a_wrong_time_ends_no_day(spark, tmp_path):
    path, schema = str(tmp_path / "recent"), "time_published timestamp, ticker string, id long, rank_note string"
    write = recent_sink(path, "id", n=2, days=2)
    today = datetime.now().replace(hour=1, minute=0, second=0, microsecond=0)
    first = [(today, "A", i, "x") for i in range(4)] + [(None, "A", 9, "x"), (today, None, 10, "x")]
    second = [(datetime(2999, 1, 1), "A", 11, "x")]
    for n, rows in enumerate([first, second, [], second[:0]]):
        for _ in range(1 + (n == 1)):  # a micro-batch that runs again
            write(spark.createDataFrame(rows, schema), n)
    got = sorted((str(r.ticker), r["rank"], r.id) for r in read_recent(spark, path, "id", 2).collect())
    assert got == [("A", 1, 11), ("A", 2, 0), ("None", 1, 10)]
    assert len(children(spark, path)) == 2


def test_days_that_have_passed_leave_the_lists(spark, tmp_path):
    rnd, path, seen = random.Random(5), str(tmp_path / "recent"), []
    schema = "time_published timestamp, ticker string, id long"
    write = recent_sink(path, "id", n=3, days=2)
    for n in range(4):
        rows = [(T0 + timedelta(hours=6 * rnd.randrange(4 * (n + 1))), rnd.choice(["hot", "hot", "A"]), 100 * n + i) for i in range(30)]
        seen += rows
        write(spark.createDataFrame(rows, schema), n)
    everything, flat = spark.createDataFrame(seen, schema), lambda df: sorted(map(tuple, df.collect()), key=str)
    last = max(t for t, *_ in seen)
    for back in (0, 1):
        start = (last - timedelta(days=back)).strftime("%Y-%m-%d 05:00:00")
        for n in (1, 3):
            want = flat(recent_news(everything, n, start, tiebreak="id"))
            assert flat(read_recent(spark, path, "id", n, start)) == want != []
    days = {r._day for r in spark.read.parquet(f"{path}/v=3").select("_day").distinct().collect()}
    assert days == {last.date(), (last - timedelta(days=1)).date()}
