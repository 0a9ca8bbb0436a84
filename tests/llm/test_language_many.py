"""Training on more languages than 64, also with two landmarks a language."""

import random

import numpy as np
import pytest

from tickcast.llm import language
from tickcast.llm.common import arrow_settings


def texts_of(k, n):
    """Texts of language ``k``: words over a few letters of its own."""
    rnd = random.Random(k)
    letters = rnd.sample("abcdefghijklmnopqrstuvwxyz", 6)
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 7))) for _ in range(25)]
    return [" ".join(rnd.choice(words) for _ in range(40)) for _ in range(n)]


@pytest.mark.parametrize("landmarks", [1536, 160])
def test_every_language_is_learned(spark, landmarks, monkeypatch):
    monkeypatch.setattr(language, "LANDMARKS", landmarks, raising=False)
    rows = [(f"l{k:02}", t, i < 8) for k in range(80) for i, t in enumerate(texts_of(k, 10))]
    df = spark.createDataFrame(rows, "lang string, text string, train boolean")
    with arrow_settings(spark):
        model = language.train(df.filter("train"))
        got = language.identify(df.filter("not train"), model).collect()
    assert model.langs == sorted({x for x, _, _ in rows}) and len(model.bits) == min(landmarks, 80 * 8)
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.98
