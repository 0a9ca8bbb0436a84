import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("rank", T.StringType()), T.StructField("spans", T.StringType())])


def passage(seed: int, words: int) -> str:
    import random

    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklmnoprstuvwy") for _ in range(rnd.randrange(2, 9))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls, empties, ties, repeated rows, long texts, clashing extra columns."""
    base, shared = passage(1, 200), passage(2, 40)
    near = base.split()
    near[10] = "changed"
    texts = [
        (0, base, "en"), (1, base, "en"), (2, " ".join(near), "en"), (3, None, "en"), (4, "", None), (5, "   \n\t ", "fr"),
        (6, passage(3, 60) + " " + shared, "de"), (7, passage(4, 60) + " " + shared + " é日本", "de"), (8, "one two", None), (9, "12 34 !!", "en"),
        (10, "x" * 5000, "en"), (11, passage(5, 30000), "fr"), (12, "mail a.b@c.de or +1 (425) 555-9684, again 14255559684; 10.0.0.1; 4111 1111 1111 1111", "en"),
        (13, "Released under the MIT License.", "en"), (13, "Released under the MIT License.", "en"), (14, "ab " * 400, "es"), (15, "<|endoftext|> it's", "en"), (None, base, "en"), (-7, passage(6, 80), "es"),
    ]
    return [(i, t, x, "s", len(t) if t else None, "r", "z") for i, t, x in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
