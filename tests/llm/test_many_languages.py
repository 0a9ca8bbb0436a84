"""Inputs of more languages than are broadcast."""

import random

import pytest

from tickcast.llm import quality
from tickcast.llm.common import arrow_settings


@pytest.fixture(scope="module")
def reference_docs():
    """70 languages of 31 texts and one of 5; a language's texts look alike."""
    rnd = random.Random(5)
    rows = []
    for k in range(71):
        word = f"w{'xyzXYZ0189'[k % 10] * (1 + k // 10)}"
        for _ in range(31 if k < 70 else 5):
            rows.append((len(rows), " ".join(f"{word}{rnd.randrange(10**6)}" for _ in range(120)), f"l{k}"))
    return rows


def test_every_language_has_its_reference(spark, reference_docs, monkeypatch):
    df = spark.createDataFrame([*reference_docs, (9999, None, None)], "doc_id long, text string, lang string")
    with arrow_settings(spark):
        got = {r.doc_id: r for r in quality.quality(df).collect()}
        monkeypatch.setattr(quality, "LANGS", 1000)
        want = {r.doc_id: r for r in quality.quality(df).collect()}
    assert got.keys() == want.keys() == {*range(len(reference_docs)), 9999}
    for i, r in want.items():
        assert got[i].kept == r.kept and got[i].class_distance == (r.class_distance and pytest.approx(r.class_distance, abs=1e-9))
        assert got[i].word_distance == (r.word_distance and pytest.approx(r.word_distance, abs=1e-9))
