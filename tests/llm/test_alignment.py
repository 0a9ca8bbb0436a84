"""Token alignment against the two libraries and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from tickcast.llm import alignment as A

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(PATHS[0]), SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    # the byte alphabet of the file: printable bytes stand for themselves, the others follow from U+0100
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in plain]
    back = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}
    of_a = lambda i: bytes(back[c] for c in a.id_to_token(i))
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, of_a, of_b


def brute(rows):
    a, b, of_a, of_b = libraries()
    out, links, total = [], [], Counter()
    for doc_id, text in rows:
        want = (" " + (text or "")).encode()
        ia, ib = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        ba, bb = [of_a(i) for i in ia], [of_b(i) for i in ib]
        if not text or b"".join(ba) != want or b"".join(bb) != want:
            out.append((doc_id, 0, 0, 0, 0, ""))
            links.append([])
            continue
        ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        groups = []
        i = j = 0
        for e in sorted(set(ea) & set(eb)):
            i2, j2 = ea.index(e) + 1, eb.index(e) + 1
            groups.append(",".join(map(str, ia[i:i2])) + "|" + ",".join(map(str, ib[j:j2])))
            i, j = i2, j2
        own = [(x, y) for x, s, e in zip(ia, [0, *ea], ea) for y, s2, e2 in zip(ib, [0, *eb], eb) if s < e2 and s2 < e]
        total.update(own)
        links.append(own)
        out.append((doc_id, len(ia), len(ib), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (_, y), c in total.items():
        top[y] = max(top[y], c)
    return sorted((*r[:5], sum(total[x] == top[x[1]] for x in own), sum(total[x] for x in own), r[5]) for r, own in zip(out, links))


def odd_texts():
    rnd = random.Random(5)
    bits = ["hello", " world", "  ", "\n", "é", "日本語", "😀", "123456", "<s>", "</s>", "<|endoftext|>", "<0x41>", "▁", "\x00", "\t", "unbelievable", "'s", ".", "ing", "xqzt", " the"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randrange(12))) for _ in range(150)]
    return list(enumerate([*texts, None, "", " ", "▁", "a", "the end " * 60, texts[3], "x" * 300]))


def test_alignment(spark):
    rows = odd_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("links", A.F.lit(1)).withColumn("pair", A.F.lit("z"))
    assert sorted(map(tuple, A.align_tokens(df, *PATHS).collect())) == brute(rows)


def test_small_blocks(spark, monkeypatch):
    """Counts are corpus-wide whatever the blocks are."""
    rows = odd_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    whole = sorted(map(tuple, A.align_tokens(df, *PATHS).collect()))
    monkeypatch.setattr(A, "BLOCK", A.BLOCK)
    real = A.aligned_blocks

    def small(*paths):
        run = real(*paths)

        def each(batches):
            A.BLOCK = 40
            return run(x for batch in batches for x in (batch.slice(i, 3) for i in range(0, batch.num_rows, 3)))

        return each

    monkeypatch.setattr(A, "aligned_blocks", small)
    assert sorted(map(tuple, A.align_tokens(df, *PATHS).collect())) == whole


@pytest.mark.parametrize("window", [1, 2, 7, 1 << 16])
def test_windows_and_runs(monkeypatch, window):
    monkeypatch.setattr(A, "WINDOW", window)
    rnd = random.Random(window)
    for _ in range(200):
        n = rnd.randrange(1, 120)
        ends_a = sorted({*rnd.sample(range(1, n + 1), rnd.randrange(n)), n})
        ends_b = sorted({*(x for x in ends_a if rnd.random() < 0.9), *rnd.sample(range(1, n + 1), rnd.randrange(1 + n // 8)), n})
        cut_a, cut_b, link_a, link_b = A.align(np.array(ends_a), np.array(ends_b))
        common = sorted(set(ends_a) & set(ends_b))
        assert [ends_a[x - 1] for x in cut_a] == common == [ends_b[x - 1] for x in cut_b]
        over = [(i, j) for i, (s, e) in enumerate(zip([0, *ends_a], ends_a)) for j, (s2, e2) in enumerate(zip([0, *ends_b], ends_b)) if s < e2 and s2 < e]
        assert sorted(zip(link_a.tolist(), link_b.tolist())) == over


def test_packed_links():
    rnd = np.random.default_rng(0)
    for high in (1, 5, 300, 10**6):
        number = rnd.integers(0, high, 500)
        own, count = A.unpack_links(A.pack_links(number))
        want = Counter(number.tolist())
        assert dict(zip(own.tolist(), count.tolist())) == want
    assert A.unpack_links(A.pack_links(np.zeros(0, np.int64)))[0].tolist() == []


def test_odd_rows(spark, odd, none):
    got = {r.doc_id: r for r in A.align_tokens(odd, *PATHS).collect()}
    assert got[3].n_a == got[4].n_links == 0 and got[3].groups_sha256 == "" and got[11].n_links == got[11].n_a + got[11].n_b - got[11].n_groups
    assert A.align_tokens(none, *PATHS).count() == 0
