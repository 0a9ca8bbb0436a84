"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans. The nodes of a document's random field are its
base spans (their kind is observed) and other candidates: number phrases and
words with an @. Node potentials come from a softmax regression on features of
the candidate and the word before it, chain potentials from label counts of
neighbours; skip edges join a candidate to the next one with the same key
(equal last digits, or equal text), near or far. Damped loopy message passing
gives the marginals; a candidate whose best kind is sure becomes a span, so a
number written once with its marks is found where it stands without them.

The patterns can't teach what they miss. So training hides the marks of half of
the phones and e-mails among the base spans (the plus sign, the separators, the
end of the domain): a hidden one keeps its label, has the features of the
unmarked form, and stands in place of the span or beside it as a repeat. Node
weights and skip potentials are fitted together by pseudo-likelihood on these
and on the candidates that are no base spans.

The field is trained on at most TRAIN_DOCS documents (the smallest text hashes
with a candidate), the first TRAIN_NODES nodes of each; a document to be searched
is read whole, with all its nodes.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.llm.common import arrow_settings, stage

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
TRAIN_DOCS = 2000
TRAIN_NODES = 256
FEATURES = 256
SURE = 0.9
ROUNDS = 12
DAMPING = 0.5

DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NUMBER = re.compile(r"(?<![0-9A-Za-z_])[0-9][0-9().-]*(?: [0-9(][0-9().-]*)*(?![0-9A-Za-z_])")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches, driven by the @ signs (linear time)."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        # the next local part lies right of this @, or right of the match
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(map(small, m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = NOT_DIGIT.sub("", m[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, label) of the nodes: base spans and what else may be one."""
    nodes = [(s, e, k + 1) for s, k, e in base]
    edges = sorted((s, e) for s, e, _ in nodes)
    starts, reach = [s for s, _ in edges], list(accumulate((e for _, e in edges), max))

    def free(s: int, e: int) -> bool:
        n = bisect_left(starts, e)  # base spans that begin before the end
        return not n or reach[n - 1] <= s

    for m in NUMBER.finditer(text):
        if m.end() - m.start() >= 7 and 7 <= len(NOT_DIGIT.sub("", m[0])) <= 19:
            end = m.start() + len(m[0].rstrip("().- "))
            if free(m.start(), end):
                nodes.append((m.start(), end, 0))
    at = text.find("@")
    while at >= 0:
        s, e = at, at + 1
        while s and not text[s - 1].isspace():
            s -= 1
        while e < len(text) and not text[e].isspace():
            e += 1
        if free(s, e) and e - s > 2:
            nodes.append((s, e, 0))
        at = text.find("@", e)
    return sorted(set(nodes))


def possible(own: str, kind: int) -> bool:
    """Whether a span added as ``kind`` has that kind's digits (or its @)."""
    digits = NOT_DIGIT.sub("", own)
    if kind == 0:
        return "@" in own
    if kind == 1:
        return IP.fullmatch(own) is not None and all(map(small, own.split(".")))
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 9 <= len(digits) <= 15


def features(text: str, start: int, end: int) -> list[int]:
    """Hashed feature numbers of a node."""
    return features_of(text[start:end], text[max(0, start - 40) : start])


def features_of(own: str, before: str) -> list[int]:
    digits, words = NOT_DIGIT.sub("", own), before.split()
    names = [
        "bias",
        f"digits {len(digits)}",
        f"signs {''.join(sorted(set(re.sub('[0-9A-Za-z]', '', own))))}",
        f"at {own.count('@')}",
        f"dots {min(own.count('.'), 4)}",
        f"luhn {bool(digits) and luhn(digits)}",
        f"first {own[0] if not own[0].isalnum() else 'x'}",
        f"before {words[-1].lower() if words else ''}",
    ]
    return [zlib.crc32(x.encode()) % FEATURES for x in names]


def key_of(own: str) -> str:
    """What repeats of a node have in common: the name before the @, the last
    nine digits of a number, else the text."""
    if "@" in own:
        name = own.partition("@")[0]
        at = len(name)
        while at and name[at - 1] in LOCAL_CHARS:
            at -= 1
        return name[at:].lower() + "@"
    digits = NOT_DIGIT.sub("", own)
    return digits[-9:] if len(digits) >= 7 else own.lower()


def unmarked(own: str, kind: int, form: int) -> str | None:
    """A phone or e-mail as it may stand without its marks; None for others."""
    if kind == 0:
        name, _, domain = own.partition("@")
        return f"{name}@{domain.partition('.')[0]}"
    if kind != 3:
        return None
    digits = NOT_DIGIT.sub("", own)
    return [own[1:], digits, f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}"][form % 3 if len(digits) >= 10 else form % 2]


class SkipChain:
    """Node weights (features x labels), chain and skip log-potentials."""

    def __init__(self, weights: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.weights, self.chain, self.skip = weights, chain, skip

    @classmethod
    def fit(cls, docs: list[list[tuple[list[int], int, str, bool]]], steps: int = 300, rate: float = 2.0) -> SkipChain:
        """From nodes (features, label, key, hidden) of labelled documents. Nodes
        that a text to be searched may hold unlabelled are fitted: hidden base
        spans and candidates of label none; the labels beside them are given."""
        n = len(LABELS)
        flat, labels, beside, chained = [], [], [], []
        pairs, prior = Counter(), np.ones(n)
        for d in docs:
            pairs.update((a[1], b[1]) for a, b in zip(d, d[1:]))
            at: dict[str, list[int]] = {}
            for i, (_, label, key, _) in enumerate(d):
                prior[label] += 1
                at.setdefault(key, []).append(i)
            near: dict[int, list[int]] = {}
            for same in at.values():
                for a, b in zip(same, same[1:]):
                    near.setdefault(a, []).append(b)
                    near.setdefault(b, []).append(a)
            for i, (f, label, _, hidden) in enumerate(d):
                if hidden or not label:
                    flat.append(f)
                    labels.append(label)
                    beside.append([d[j][1] for j in near.get(i, [])])
                    chained.append((d[i - 1][1] if i else -1, d[i + 1][1] if i + 1 < len(d) else -1))
        if not flat:
            return cls(np.zeros((FEATURES, n)), np.zeros((n, n)), np.zeros((n, n)))
        table = np.array([[pairs[a, b] + 1.0 for b in range(n)] for a in range(n)])
        chain = np.clip(np.log(table / table.sum()) - np.log(np.outer(prior, prior) / prior.sum() ** 2), -1, 1)
        x, k, given = np.zeros((len(flat), FEATURES)), np.zeros((len(flat), n)), np.zeros((len(flat), n))
        for i, f in enumerate(flat):
            x[i, f] = 1
            for label in beside[i]:
                k[i, label] += 1
            left, right = chained[i]
            given[i] = (chain[left] if left >= 0 else 0) + (chain[:, right] if right >= 0 else 0)
        y = np.eye(n)[labels]
        w, s = np.zeros((FEATURES, n)), np.zeros(n)
        for _ in range(steps):
            p = softmax(x @ w + k * s + given)
            w -= rate * (x.T @ (p - y) / len(x) + 1e-3 * w)
            s -= rate * ((k * (p - y)).sum(0) / len(x) + 1e-3 * s)
        return cls(w, chain, np.diag(s))

    def marginals(self, feats: list[list[int]], labels: list[int], keys: list[str]) -> np.ndarray:
        """Loopy message passing; an observed label (> 0) is clamped."""
        n, m = len(feats), len(LABELS)
        unary = np.array([self.weights[f].sum(0) for f in feats])
        for i, x in enumerate(labels):
            if x:
                unary[i] = -50.0
                unary[i, x] = 0.0
        edges = [(i, i + 1, self.chain) for i in range(n - 1)]
        last: dict[str, int] = {}
        for i, k in enumerate(keys):
            if k in last:
                edges.append((last[k], i, self.skip))
            last[k] = i
        if not edges:
            return softmax(unary)
        src = np.array([e[0] for e in edges] + [e[1] for e in edges])
        dst = np.array([e[1] for e in edges] + [e[0] for e in edges])
        pot = np.array([e[2] for e in edges] + [e[2].T for e in edges])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        msg = np.zeros((len(src), m))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, dst, msg)
            out = belief[src] - msg[back]
            new = log_sum(out[:, :, None] + pot)
            new -= new.max(1, keepdims=True)
            msg = DAMPING * msg + (1 - DAMPING) * new
        belief = unary.copy()
        np.add.at(belief, dst, msg)
        return softmax(belief)

    def added(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans the field adds to the base ones."""
        nodes = candidates(text, base)
        if all(x[2] for x in nodes):
            return []
        p = self.marginals([features(text, s, e) for s, e, _ in nodes], [x[2] for x in nodes], [key_of(text[s:e]) for s, e, _ in nodes])
        best = p.argmax(1)
        return [(s, int(b) - 1, e) for (s, e, label), b, q in zip(nodes, best, p) if not label and b and q[b] >= SURE and possible(text[s:e], int(b) - 1)]


def softmax(x: np.ndarray) -> np.ndarray:
    p = np.exp(x - x.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1)
    return top + np.log(np.exp(x - top[:, None, :]).sum(1))


def training_nodes(text: str) -> list[tuple[list[int], int, str, bool]]:
    """(features, label, key, hidden) of the nodes of a training text."""
    out = []
    for start, end, label in candidates(text, base_spans(text))[:TRAIN_NODES]:
        own, before = text[start:end], text[max(0, start - 40) : start]
        code = zlib.crc32(f"{own} {start}".encode())
        bare = unmarked(own, label - 1, code >> 2) if label else None
        if bare is None or code % 4:  # stands as it is
            out.append((features_of(own, before), label, key_of(own), False))
        if bare is not None and code % 4 < 2:  # hidden in its place (0), or a repeat beside it (1)
            out.append((features_of(bare, before), label, key_of(bare), True))
    return out


def labelled_nodes(batches):
    """mapInArrow: texts -> nodes of those that have any, for training."""
    for batch in batches:
        h, feats, labels, keys, hidden = [], [], [], [], []
        for code, text in zip(batch.column("h").to_pylist(), batch.column("text").to_pylist()):
            nodes = training_nodes(text)
            if nodes:
                h.append(code)
                feats.append([x for f, _, _, _ in nodes for x in f])
                labels.append([x for _, x, _, _ in nodes])
                keys.append([zlib.crc32(x.encode()) for _, _, x, _ in nodes])
                hidden.append([x for _, _, _, x in nodes])
        types = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.bool_()))
        cols = [pa.array(v, t) for v, t in zip((h, feats, labels, keys, hidden), types)]
        yield pa.RecordBatch.from_arrays(cols, names=["h", "feats", "labels", "keys", "hidden"])


def train(docs: DataFrame) -> SkipChain:
    texts = docs.filter(F.col("text").rlike("[0-9]{4}|@")).select(F.xxhash64("text").alias("h"), "text")
    low = texts.select("h").distinct().orderBy("h").limit(TRAIN_DOCS).agg(F.max("h")).first()[0]
    if low is None:
        return SkipChain.fit([])
    schema = "h long, feats array<int>, labels array<int>, keys array<long>, hidden array<boolean>"
    rows = texts.filter(F.col("h") <= low).dropDuplicates(["h"]).mapInArrow(labelled_nodes, schema)
    got = sorted((r.h, r.feats, r.labels, r.keys, r.hidden) for r in rows.collect())
    return SkipChain.fit(
        [[(f[8 * i : 8 * i + 8], x, str(k), m) for i, (x, k, m) in enumerate(zip(labels, keys, hidden))] for _, f, labels, keys, hidden in got]
    )


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def found_spans(model: SkipChain):
    """mapInArrow: documents -> base and all spans as text, the base counts."""

    def run(batches):
        for batch in batches:
            counts, base_text, all_text = [], [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                base = base_spans(text)
                counts.append([sum(k == i for _, k, _ in base) for i in range(len(KINDS))])
                base_text.append(written(base))
                all_text.append(written(sorted(base + model.added(text, base))))
            cols = [batch.column(n) for n in batch.schema.names if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            table = np.array(counts, np.int64).reshape(-1, len(KINDS))
            cols += [pa.array(table[:, i]) for i in range(len(KINDS))] + [pa.array(base_text, pa.string()), pa.array(all_text, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *(f"n_{k}" for k in KINDS), "base_spans", "spans"])

    return run


def find_pii(docs: DataFrame, model: SkipChain) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans) of every row;
    the counts are of base spans, a null text is empty."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(found_spans(model), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def masked_texts(model: SkipChain):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, text in enumerate(texts):
                if text:
                    base = base_spans(text)
                    spans = sorted(base + model.added(text, base))
                    if spans:
                        texts[i] = masked(text, spans)
            cols = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return run


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans in ``text`` replaced by <KIND>; a null or empty
    text stays, repeated rows are masked each, every column is kept, and an
    empty table stays empty. A plan over ``docs``."""
    with arrow_settings(docs.sparkSession):
        return docs.mapInArrow(masked_texts(train(docs)), docs.schema)


def op8_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with arrow_settings(spark):
        found = find_pii(docs, train(docs)).withColumn("base_spans", F.sha2("base_spans", 256)).withColumnRenamed("base_spans", "base_sha256")
        return stage(found, "op8")
