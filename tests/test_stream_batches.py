"""Micro-batch functions, called batch by batch: pairing with carried slots,
late articles, copies of messages."""

import random
from datetime import datetime, timedelta

from folds import fold_pairs
from pyspark.sql import functions as F

from tickcast.operators.sentiment import daily_sentiment
from tickcast.schemas import MESSAGE, NEWS
from tickcast.sources.sinks import write_batch
from tickcast.sources.snapshots import children
from tickcast.streaming.jobs import once
from tickcast.streaming.late import late_sink, read_daily, read_late, read_partials
from tickcast.streaming.pairing import pair_batches
from tickcast.streaming.sources import FORMAT_NEWS, FORMAT_PRICES, topic_stream

T0 = datetime(2024, 1, 1)


def test_pairs_are_the_same_however_the_log_is_cut(spark, tmp_path):
    rnd = random.Random(11)
    logs = {s: [(i, rnd.choice(["news", "prices"]), rnd.random() < 0.25) for i in range(n)] for s, n in (("hot", 60), ("A", 9), ("once", 1))}
    rows = [(s, "[]" if e else f'["{s}{i}"]', FORMAT_NEWS if k == "news" else FORMAT_PRICES, i, None) for s, m in logs.items() for i, k, e in m]
    rows += [(None, '["x"]', FORMAT_NEWS, 5, None)]
    want = sorted((s, *p) for s, m in logs.items() for p in fold_pairs(m))
    for cuts in ([0, 99], [0, 7, 8, 8, 31, 99]):
        base = str(tmp_path / str(len(cuts)))
        write = pair_batches(f"{base}/slots", lambda df, n, base=base: write_batch(df, f"{base}/pairs", n), chunk_size=8)
        for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
            some = spark.createDataFrame([r for r in rows if low <= r[3] < high], MESSAGE)
            for _ in range(1 + (n == 1)):  # a micro-batch that runs again
                write(some, n)
        got = spark.read.parquet(f"{base}/pairs").collect()
        assert sorted((r.symbol, r.seq, r.news_seq, r.prices_seq) for r in got) == want
        assert all(r.news_value == f'["{r.symbol}{r.news_seq}"]' and r.prices_value == f'["{r.symbol}{r.prices_seq}"]' for r in got)
        slots = [x for x in children(spark, f"{base}/slots")]
        assert len(slots) <= 2 and spark.read.parquet(f"{base}/slots/{slots[-1]}").count() <= 3


def test_late_articles_are_kept(spark, tmp_path):
    rnd, path = random.Random(2), str(tmp_path / "late")
    seen, latest, want_late = [], None, 0
    write = late_sink(path, "1 day")
    for n in range(4):
        times = [None if rnd.random() < 0.1 else T0 + timedelta(hours=rnd.randrange(24 * 9) if n != 1 else 24 * 6) for _ in range(0 if n == 2 else 40)]
        rows = [(t, rnd.choice("AB"), rnd.choice([None, 0.5, -0.5]), rnd.choice(["Bullish", "Bearish", "Neutral"]), 1.0, 0.1, "x") for t in times]
        closed = lambda t: t and latest and datetime(t.year, t.month, t.day) + timedelta(days=2) <= latest  # noqa: B023, E731
        want_late += sum(bool(closed(t)) for t in times)
        latest = max([t for t in [latest, *times] if t], default=None)
        seen += rows
        for _ in range(1 + (n == 3)):  # a micro-batch that runs again
            write(spark.createDataFrame(rows, NEWS), n)
    flat = lambda df: sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)
    assert flat(read_daily(spark, path, with_late=True)) == flat(daily_sentiment(spark.createDataFrame(seen, NEWS)))
    assert read_late(spark, path).count() == want_late > 0
    assert read_partials(spark, path).agg(F.sum("articles")).first()[0] == len(seen) - want_late


def test_copies_of_messages_are_dropped(spark, tmp_path):
    base = str(tmp_path)
    value = lambda seq, day: f'{{"symbol":"A","pair_seq":{seq},"date":"{day}"}}'
    first = [("A", value(1, "2024-01-01"), "t", 0, T0), ("A", value(1, "2024-01-02"), "t", 1, T0), ("A", '{"symbol":"A"}', "t", 2, T0)]
    again = first[:2] + [("A", value(2, "2024-01-01"), "t", 3, T0 + timedelta(minutes=5)), ("A", '{"symbol":"A"}', "t", 4, T0)]
    for rows in (first, again):
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").json(f"{base}/in")
        src = once(topic_stream(spark, ["t"], path=f"{base}/in"))
        sink = lambda df, n: write_batch(df, f"{base}/out", n)
        src.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start().awaitTermination()
    got = [r.value for r in spark.read.parquet(f"{base}/out").collect()]
    assert sorted(got) == sorted([value(1, "2024-01-01"), value(1, "2024-01-02"), value(2, "2024-01-01"), '{"symbol":"A"}', '{"symbol":"A"}'])
