"""Coefficients from stored moments equal a refit of all history."""

import random
from datetime import date, timedelta

import pytest

from tickcast.operators.forecast import fit_next_close, update_fit, with_next_rows
from tickcast.schemas import PRICE_MEASURES

DAY = date(2024, 1, 1)


def bars(seed):
    rnd = random.Random(seed)
    rows = []
    for s, n in (("A", 60), ("B", 45), ("C", 2), ("D", 30)):
        for i in range(n):
            if rnd.random() < 0.1:
                continue
            row = {m: rnd.uniform(1, 100) for m in PRICE_MEASURES}
            row["split_coefficient"] = 1.0  # constant
            row["volume"] *= 1e6
            if rnd.random() < 0.05:
                row["adjusted_close"] = None
            rows.append((s, DAY + timedelta(days=i), *(row[m] for m in PRICE_MEASURES)))
    return rows


@pytest.mark.parametrize("as_ofs", [["2024-02-20"] * 4, ["2024-01-08", "2024-01-20", "2024-01-20", "2024-02-20"]])
def test_batches_of_days(spark, tmp_path, as_ofs):
    schema = "symbol string, date date, " + ", ".join(f"{m} double" for m in PRICE_MEASURES)
    rows = bars(len(set(as_ofs)))
    cuts = [0, 10, 11, 40, 99]
    for i, as_of in enumerate(as_ofs):
        some = [r for r in rows if cuts[i] <= (r[1] - DAY).days < cuts[i + 1]]
        for _ in range(1 + (i == 2)):  # a batch that runs again replaces itself
            got = update_fit(spark, str(tmp_path / "fit"), spark.createDataFrame(some, schema), i, as_of)
    seen = spark.createDataFrame(rows, schema)
    want = {r.symbol: r for r in fit_next_close(with_next_rows(seen), as_ofs[-1]).collect()}
    found = {r.symbol: r for r in got.collect()}
    assert found.keys() == want.keys() and {"A", "B", "D"} <= found.keys()
    for s, r in found.items():
        assert r.n_train == want[s].n_train
        assert list(r)[2:] == pytest.approx(list(want[s])[2:], rel=1e-6, abs=1e-9)
    assert all("/fit/moments/" in x for x in got.inputFiles())  # no bars of earlier batches
