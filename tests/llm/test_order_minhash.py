"""Order MinHash against a plain loop, and the order of the documents."""

import hashlib
import random

import numpy as np

from tickcast.llm import order_minhash as O


def plain_elements(text):
    """(k-mer, occurrence number) in text order."""
    k = min(O.K, len(text))
    seen, out = {}, []
    for i in range(len(text) - k + 1 if text else 0):
        kmer = text[i : i + k]
        out.append((kmer, seen.get(kmer, 0)))
        seen[kmer] = seen.get(kmer, 0) + 1
    return out


def plain_tuples(text):
    """Of each permutation the k-mers of the selected elements, in text order."""
    _, values = O.elements(text)
    want = plain_elements(text)
    assert len(values) == len(want)
    out = []
    for a in O.multipliers().tolist():
        ranked = sorted((v * a % 2**32, i) for i, v in enumerate(values.tolist()))[: O.TUPLE]
        out.append(tuple(want[i][0] for i in sorted(i for _, i in ranked)))
    return out


def some_texts():
    rnd = random.Random(4)
    base = "".join(rnd.choice("abcdé 日") for _ in range(900))
    swapped = base[450:] + base[:450]
    return ["", "a", "abcd", "abcde", "aaaaaa", "ab" * 300, base, swapped, base[:400] + "X" + base[400:], base * 5, "\U0001f600" * 9]


def test_equal_tuples_give_equal_components():
    texts = some_texts()
    with np.errstate(over="ignore"):
        prints = [O.fingerprint(t) for t in texts]
        tuples = [plain_tuples(t) for t in texts]
    for i, a in enumerate(texts):
        for j, _ in enumerate(texts):
            assert [x == y for x, y in zip(tuples[i], tuples[j])] == (prints[i] == prints[j]).tolist() or a == ""


def test_values_number_occurrences():
    with np.errstate(over="ignore"):
        kmers, values = O.elements("abababab")
        again, _ = O.elements("xabababab")
    assert len(set(kmers.tolist())) == 2 and len(set(values.tolist())) == 4 and again[1:].tolist() == kmers.tolist()


def test_likeness_falls_with_edits_and_order():
    rnd = random.Random(8)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(4000))

    def changed(rate):
        return "".join(rnd.choice("xyz") if rnd.random() < rate else c for c in base)

    with np.errstate(over="ignore"):
        own = O.fingerprint(base)
        by_rate = [O.likeness(own, O.fingerprint(changed(r))) for r in (0.002, 0.03, 0.2)]
        cuts = [base[i : i + 40] for i in range(0, 4000, 40)]
        rnd.shuffle(cuts)
        assert by_rate[0] > by_rate[1] > by_rate[2]
        # about as many k-mers in common as at a rate of 0.02, in another order
        assert O.likeness(own, O.fingerprint("".join(cuts))) < 0.7
        assert O.likeness(own, own) == 1


def test_long_text_in_segments(monkeypatch):
    text = "".join(random.Random(1).choice("abc") for _ in range(3000))
    with np.errstate(over="ignore"):
        whole = O.fingerprint(text)
        monkeypatch.setattr(O, "SEGMENT", 77)
        assert (O.fingerprint(text) == whole).all()


def brute(rows):
    with np.errstate(over="ignore"):
        rows = [(d, t or "") for d, t in rows]
        out = []
        for i, (d, t) in enumerate(rows):
            after = rows[(i + 1) % len(rows)][1]
            n = len(t) // 4
            other = t[: len(t) - n] + after[:n]
            a, b, c = O.fingerprint(t), O.fingerprint(other), O.fingerprint(after)
            out.append((d, len(t), hashlib.sha256(other.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), float((a == b).mean()), float((a == c).mean())))
        return out


def test_every_document_meets_the_next(spark, monkeypatch):
    rnd = random.Random(2)
    rows = [(3 * i - 50, "".join(rnd.choice("abcd é") for _ in range(rnd.randrange(200)))) for i in range(120)] + [(1000, None), (1001, ""), (1002, "日本語" * 30), (5000, "z" * 50000)]
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    for parts in (1, 7, 60):
        monkeypatch.setattr(O, "partitions", lambda s: parts)
        df = spark.createDataFrame(shuffled, "doc_id long, text string").withColumn("part", O.F.lit("mine")).withColumn("n_chars", O.F.lit("x"))
        assert sorted(map(tuple, O.order_prints(df).collect())) == sorted(brute(rows))


def test_odd_rows(spark, odd, none):
    got = O.order_prints(odd).collect()
    assert len(got) == odd.count() and len({r.fingerprint for r in got if r.doc_id == 13}) == 1
    by = {r.doc_id: r for r in got}
    assert by[0].fingerprint == by[1].fingerprint and by[0].near_next == 1 and by[3].n_chars == 0 and by[None].n_chars == by[0].n_chars
    assert by[3].fingerprint == by[4].fingerprint and by[4].near_edited == 1
    assert O.order_prints(none).count() == 0
    one = spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")
    assert O.order_prints(one).collect()[0].near_next == 1
