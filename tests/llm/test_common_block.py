"""One line of 32 to 99 bytes in most documents, with other neighbours in each."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tickcast.llm import suffix_dedup as S
from tickcast.llm.common import arrow_settings

LINE = "Licensed under the terms of the common licence, version two."


def common_line(n):
    rnd = random.Random(3)
    some = lambda k: "".join(rnd.choice("abcdefgh ") for _ in range(k))
    twice = [some(90) for _ in range(5)]  # partial matches: the line and what follows
    return [(i, some(rnd.randrange(60, 120)) + LINE + (rnd.choice(twice) if i % 3 else some(90))) for i in range(n)]


def test_a_common_line_spreads_by_window():
    docs = common_line(300)
    data = [np.frombuffer(t.encode(), np.uint8) for _, t in docs]
    own = []
    with np.errstate(over="ignore"):
        for d in data:
            rows = np.concatenate([r for r, _ in S.entries(np.array([0]), d, np.array([0, len(d)]), 100)])
            own.append(rows["start"].astype(np.int64) << 32 | rows["n"].astype(np.int64) << 12)
    ids, texts = zip(*docs)
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts), pa.array(own, pa.list_(pa.int64()))], names=["doc_id", "text", "loads"])
    count, codes = Counter(), Counter()
    for out in S.unsure_windows(16, 100)([batch]):
        for row in out.to_pylist():
            if row["kind"] == S.UNSURE:
                rows = S.unpack(row["payload"], S.WINDOW)
                count[row["part"]] += len(rows)
                codes.update(rows["code"].tolist())
    assert len(count) == 16 and max(count.values()) <= 2 * sum(count.values()) / 16
    assert max(codes.values()) == 1  # a common window leaves a map task once


def test_a_common_line_against_brute_force(spark):
    docs = common_line(400)
    seen, want = set(), {}
    for i, t in docs:
        b, gone = t.encode(), set()
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone.update(range(p, p + 100))
            seen.add(b[p : p + 100])
        want[i] = hashlib.sha256(bytes(x for p, x in enumerate(b) if p not in gone)).hexdigest(), len(gone)
    assert 100 < sum(n > 0 for _, n in want.values()) < 300
    with arrow_settings(spark):
        spans = {r.doc_id: np.frombuffer(r.spans, "<i8").reshape(-1, 2) for r in S.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        left = S.cut_spans(np.frombuffer(t.encode(), np.uint8), spans.get(i, ()))
        assert hashlib.sha256(left).hexdigest() == want[i][0]
