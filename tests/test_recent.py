from datetime import datetime, timedelta

from tickcast.operators.recent import recent_news

SCHEMA = "ticker string, time_published timestamp, id long"


def test_top_k_with_day_bound_and_ties(spark):
    base = datetime(2023, 5, 19, 12)
    rows = [("A", base - timedelta(hours=h), h) for h in range(40)] + [("A", base, 100), ("B", base, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = recent_news(df, 3, "2023-05-19 08:00:00", tiebreak="id").orderBy("ticker", "rank").collect()
    assert [(r.ticker, r.id, r.rank) for r in out] == [("A", 0, 1), ("A", 100, 2), ("A", 1, 3), ("B", 1, 1)]
    day = recent_news(df, 1000, "2023-05-19 08:00:00", tiebreak="id")
    assert day.filter("ticker = 'A'").count() == 14  # 13 rows 00:00..12:00 of the 19th, plus the tie


def test_salted_two_stage_equals_single_stage(spark):
    base = datetime(2023, 5, 19, 12)
    rows = [("HOT", base - timedelta(minutes=i), i) for i in range(3000)] + [("COLD", base, i) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    one = sorted(recent_news(df, 1200, tiebreak="id", salt_buckets=1).collect())
    two = sorted(recent_news(df, 1200, tiebreak="id", salt_buckets=7).collect())
    auto = sorted(recent_news(df, 1200, tiebreak="id").collect())
    assert one == two == auto and len(one) == 1205
