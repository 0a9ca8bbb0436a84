import random

from hypothesis import given, settings
from hypothesis import strategies as st

from folds import fold_pairs

from tickcast.operators.pairing import pair_latest_reset


def run_window(spark, msgs, chunk_size=4):
    rows = [("A", s, k, "[]" if e else '["x"]') for s, k, e in msgs]
    df = spark.createDataFrame(rows, "symbol string, seq long, kind string, value string")
    out = pair_latest_reset(df, chunk_size=chunk_size).collect()
    return sorted((r.seq, r.news_seq, r.prices_seq) for r in out)


def test_examples(spark):
    msgs = [(1, "news", False), (2, "news", False), (3, "prices", False),   # emit (2,3)
            (4, "prices", False), (5, "prices", False), (6, "news", False),  # emit (6,5)
            (7, "news", False), (8, "news", True), (9, "prices", False),     # empty news clears: no emit
            (10, "news", False)]                                             # emit (10,9)
    assert fold_pairs(msgs) == [(3, 2, 3), (6, 6, 5), (10, 10, 9)]
    for chunk in (1, 2, 3, 100):
        assert run_window(spark, msgs, chunk) == fold_pairs(msgs)


def test_random_logs_match_fold(spark):
    rnd = random.Random(7)
    rows, expected = [], []
    for sym in range(20):
        msgs = [(i, rnd.choice(["news", "prices"]), rnd.random() < 0.15) for i in range(rnd.randint(0, 60))]
        rows += [(f"S{sym}", s, k, "[]" if e else '["x"]') for s, k, e in msgs]
        expected += [(f"S{sym}",) + p for p in fold_pairs(msgs)]
    df = spark.createDataFrame(rows, "symbol string, seq long, kind string, value string")
    for chunk in (5, 16, 1 << 20):
        got = sorted((r.symbol, r.seq, r.news_seq, r.prices_seq) for r in pair_latest_reset(df, chunk_size=chunk).collect())
        assert got == sorted(expected)


def test_long_alternating_island_across_chunks(spark):
    # N P N P ... with no repeats forms one island spanning every chunk.
    msgs = [(i, "news" if i % 2 == 0 else "prices", False) for i in range(50)]
    msgs += [(50, "news", True), (51, "prices", False), (52, "prices", True), (53, "news", False), (54, "prices", False)]
    for chunk in (3, 4, 7):
        assert run_window(spark, msgs, chunk) == fold_pairs(msgs)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["news", "prices"]), st.booleans()), max_size=25))
def test_property_window_equals_fold(spark, seq):
    msgs = [(i, k, e) for i, (k, e) in enumerate(seq)]
    assert run_window(spark, msgs) == fold_pairs(msgs)


def test_payloads_join_the_emitted_pairs(spark):
    rows = [("A", 1, "news", '["n1"]'), ("A", 2, "news", '["n2"]'), ("A", 3, "prices", '["p3"]'), ("B", 3, "prices", '["x"]')]
    df = spark.createDataFrame(rows, "symbol string, seq long, kind string, value string")
    assert [tuple(r) for r in pair_latest_reset(df).collect()] == [("A", 3, 2, 3, '["n2"]', '["p3"]')]
