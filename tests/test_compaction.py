"""Compaction of document collections: the same documents before, while and after."""

import random
from datetime import date, timedelta

import pytest

from tickcast.schemas import DOCUMENT
from tickcast.sources import compaction
from tickcast.sources.compaction import compact_documents, compacted
from tickcast.sources.snapshots import children
from tickcast.sources.sinks import read_documents, write_documents

DAY = date(2024, 1, 1)


def combined(spark, rows):
    """(symbol, day, value) → combined rows."""
    full = [(s, None if d is None else DAY + timedelta(days=d), v, 0.0, 1, 1, 0.0, "Neutral", 0.0, "Neutral", int(v), None) for s, d, v in rows]
    names = [f.name for f in DOCUMENT.fields]
    schema = "symbol string, date date, close_price double, p double, a int, b int, c double, d string, e double, f string, t long, q double"
    return spark.createDataFrame(full, schema).toDF(*names).coalesce(1)


def held(spark, path):
    return sorted((tuple(r) for r in read_documents(spark, path).select("symbol", "date", "close_price").collect()), key=str)


def files_of(spark, path, index):
    """Data files that a reader opens for one symbol."""
    return read_documents(spark, path, resolve=False).filter(f"`index` = '{index}'").inputFiles()


def batch(rnd, n):
    return [(rnd.choice(["A", "B", "007", None]), rnd.choice([None, *range(6)]), float(n * 100 + i)) for i in range(rnd.randrange(1, 8))]


@pytest.mark.parametrize(("mode", "streamed"), [("append", True), ("upsert", False)])
def test_the_documents_stay_the_same(spark, tmp_path, mode, streamed):
    rnd, path, log = random.Random(3), str(tmp_path / "docs"), []
    assert compact_documents(spark, path) == 0
    for n in range(5):
        # one document a (symbol, date) and load, so that the newest is one
        rows = list({(s, d): (s, d, v) for s, d, v in batch(rnd, n)}.values())
        write_documents(combined(spark, rows), path, mode, load_id=n, batch_id=n if streamed else None)
        log += rows
        kept = log if mode == "append" else {(s, d): (s, d, v) for s, d, v in log}.values()
        want = sorted(((s, None if d is None else DAY + timedelta(days=d), v) for s, d, v in kept), key=str)
        if n % 3:
            compact_documents(spark, path)
        assert held(spark, path) == want
    for _ in range(2):  # the second one only drops what the first one replaced
        assert compact_documents(spark, path) and held(spark, path) == want
    state = compacted(spark, path)
    assert len(state.runs) <= 3 and children(spark, f"{path}/_compacted/data") == sorted(f"run={r}" for r in state.runs)
    left = [n for i in children(spark, path) if i.startswith("index=") for n in children(spark, f"{path}/{i}")]
    assert len({n for n in left if not n.startswith(".")}) <= 2  # the last load or micro-batches only
    if streamed:  # the last micro-batch comes again
        write_documents(combined(spark, rows), path, mode, load_id=4, batch_id=4)
        assert held(spark, path) == want


def test_readers_and_writers_meanwhile(spark, tmp_path):
    path = str(tmp_path / "docs")
    write_documents(combined(spark, [("A", 0, 1.0), ("B", 0, 1.0)]), path, "append")
    old = read_documents(spark, path)
    compact_documents(spark, path)
    assert old.count() == 2  # planned before: its files are still there
    between = read_documents(spark, path)
    write_documents(combined(spark, [("A", 1, 2.0)]), path, "append")
    compact_documents(spark, path)
    assert between.count() == 2 and len(held(spark, path)) == 3
    write_documents(combined(spark, [("A", 0, 1.0)]), path, "append")
    assert len(held(spark, path)) == 4  # appended copies stay


def test_a_failed_compaction_is_done_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    for n in range(3):
        write_documents(combined(spark, [("A", n, float(n)), ("A", 0, float(n))][: 1 + (n > 0)]), path, "upsert", load_id=n)
    want = held(spark, path)
    real = compaction.MANIFEST
    monkeypatch.setattr(compaction, "MANIFEST", "no schema at all")  # dies after the run is written
    with pytest.raises(Exception):  # noqa: B017
        compact_documents(spark, path)
    monkeypatch.setattr(compaction, "MANIFEST", real)
    assert held(spark, path) == want
    assert compact_documents(spark, path) == 1 and held(spark, path) == want


def test_files_of_a_symbol_are_bounded(spark, tmp_path):
    path = str(tmp_path / "docs")
    for n in range(8):
        write_documents(combined(spark, [("A", n, float(n))]), path, "append")
        compact_documents(spark, path)
    assert len(compacted(spark, path).runs) <= 4
    assert len(files_of(spark, path, "a")) <= 5 and len(held(spark, path)) == 8
