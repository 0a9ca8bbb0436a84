"""Toivonen mining against a direct count, whatever the sample and filter held."""

import random
import re
from collections import Counter

import pytest

from tickcast.llm import collocations as C


def brute(rows, min_count, per_lang):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    cand = {p: c for p, c in f.items() if len(p) > 2 and c >= min_count}
    out = []
    for lang in n:
        own = []
        for p, a in cand.items():
            if p[0] != lang:
                continue
            if len(p) == 3 and any(100 * c >= 50 * a and p[1:] in (q[1:3], q[2:4]) for q, c in cand.items() if len(q) == 4 and q[0] == lang):
                continue
            cuts = [(10**6 * a * a // (f[p[: k + 1]] * f[(lang, *p[k + 1 :])]), k, f[p[: k + 1]], f[(lang, *p[k + 1 :])]) for k in range(1, len(p) - 1)]
            score, _, left, right = min(cuts)
            own.append((-score, -a, " ".join(p[1:]).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(own)[:per_lang], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed):
    rnd = random.Random(seed)
    words = ["A", "b", "B", "c", "dé", "日本", "e'f", "g"] + [f"w{i}" for i in range(12)]
    rows = []
    for i in range(160):
        t = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", " "]) for _ in range(rnd.randrange(30)))
        rows.append((i, t, rnd.choice(["en", "en", "fr", None])))
    return rows + [(900, None, "en"), (901, "", None), (902, " .,\n ", "xx"), (5, "b b b b", "en"), (5, "b b b b", "en"), (903, "long " * 20000, "fr")]


@pytest.mark.parametrize("share, support, bits", [(8, 2, 24), (2, 1, 24), (1, 1, 12), (64, 50, 24), (4, 2, 6)])
def test_mining_is_exact(spark, share, support, bits):
    """A sample that proposes nothing, everything, and a filter that is full."""
    rows = texts(share)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(map(tuple, C.collocations(df, 3, 40, share, support, bits).collect()))
    assert got == brute(rows, 3, 40) and got


def test_border_failures_take_further_passes(spark, monkeypatch):
    """No sample at all: words, pairs and triples each come in by a pass of their own."""
    rows = texts(3)
    passes = []
    real = C.gram_counts
    monkeypatch.setattr(C, "gram_counts", lambda level, now, before: passes.append(level) or real(level, now, before))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sorted(map(tuple, C.collocations(df, 3, 40, 2, 10**6).collect()))
    assert got == brute(rows, 3, 40) and passes.count(3) == 3


def test_extra_columns_and_no_rows(spark, odd, none):
    clash = odd.withColumnRenamed("rank", "phrase").withColumnRenamed("spans", "score")
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    assert sorted(map(tuple, C.collocations(clash, 2, 50).collect())) == brute(rows, 2, 50)
    assert C.collocations(none).count() == 0
