"""Document fingerprints by Order MinHash.

The k-mers of a text (K code points each) are numbered by occurrence: equal
k-mers at different places are different elements. Each of SKETCHES
permutations selects the TUPLE elements of smallest value, puts them back into
text order and hashes their k-mers as one tuple; the low 16 bits are that
component of the fingerprint. So the likeness of two fingerprints, the share
of equal components, falls with edit distance and also where the same k-mers
come in another order.

A text of fewer than TUPLE elements gives the tuple of those it has, a text
shorter than K is one k-mer as a whole, and an empty text has a fingerprint of
its own that is equal to no other text's but by chance (2**-16 a component).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.llm.common import U64, arrow_settings, drop_stage, mix, partitions, stage

K = 5
TUPLE = 2
SKETCHES = 48
SEGMENT = 1 << 11  # elements valued at once, against all permutations
ENOUGH = 10  # expected elements below the first threshold of a permutation
ALL_VALUES = 2.0**32


def multipliers() -> np.ndarray:
    """An odd 32-bit multiplier for each permutation."""
    return (mix(np.arange(1, SKETCHES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) >> U64(32)).astype(np.uint32) | np.uint32(1)


def elements(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(k-mer hashes, 32-bit element values) in text order; equal values rank by place."""
    cps = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(U64)
    if not len(cps):
        return np.zeros(0, U64), np.zeros(0, np.uint32)
    k = min(K, len(cps))
    h = np.full(len(cps) - k + 1, U64(k))
    for i in range(0, k, 3):  # three code points of 21 bits fill a word
        three = sum((cps[j : j + len(h)] + U64(1)) << U64(21 * (j - i)) for j in range(i, min(i + 3, k)))
        h = mix(h * U64(0xC2B2AE3D27D4EB4F) + three)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    first = np.append(True, ranked[1:] != ranked[:-1])
    at = np.arange(len(h))
    number = np.empty(len(h), U64)
    number[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return h, (mix(h + mix(number + U64(0x51ED270B))) >> U64(32)).astype(np.uint32)


def smallest(values: np.ndarray, factors: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(permutation, place, value) of the values up to ``limit`` under each factor."""
    top = np.uint32(min(int(limit), 2**32 - 1))
    width = min(SEGMENT, len(values))
    room, low = np.empty((len(factors), width), np.uint32), np.empty((len(factors), width), bool)
    perm, place, value = [], [], []
    for s in range(0, len(values), SEGMENT):
        part = values[s : s + SEGMENT]
        if len(part) < width:
            room, low = room[:, : len(part)].copy(), low[:, : len(part)].copy()
        np.multiply(part[None], factors[:, None], out=room)
        np.less_equal(room, top, out=low)
        if low.size % 8:
            hit = np.flatnonzero(low)
        else:  # few are set: look at eight at a time
            some = np.flatnonzero(low.ravel().view(U64))
            eight, one = np.nonzero(low.reshape(-1, 8)[some])
            hit = some[eight] * 8 + one
        p, at = np.divmod(hit, len(part))
        perm.append(p)
        place.append(at + s)
        value.append(room.ravel()[hit])
    return np.concatenate(perm), np.concatenate(place), np.concatenate(value)


def fingerprint(text: str) -> np.ndarray:
    """The components of a text's fingerprint (SKETCHES of 16 bits)."""
    kmers, values = elements(text)
    n = min(TUPLE, len(kmers))
    tuples = np.full(SKETCHES, U64(n))
    if n:
        factors = multipliers()
        todo, limit = np.arange(SKETCHES), ENOUGH * ALL_VALUES / len(values)
        while len(todo):
            perm, place, value = smallest(values, factors[todo], limit)
            enough = np.bincount(perm, minlength=len(todo)) >= n
            order = np.lexsort((place, value, perm))
            perm, place = perm[order], place[order]
            begin = np.searchsorted(perm, np.flatnonzero(enough))
            chosen = np.sort(place[begin[:, None] + np.arange(n)], axis=1)
            code = np.full(len(chosen), U64(n))
            for i in range(n):
                code = mix(code * U64(0x9E3779B97F4A7C15) + kmers[chosen[:, i]])
            tuples[todo[enough]] = code
            todo, limit = todo[~enough], limit * 8
    return (mix(tuples + np.arange(SKETCHES, dtype=U64)) & U64(0xFFFF)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, after: str) -> str:
    """``text`` with its last quarter replaced by as much of the next one's beginning."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def result(doc_id, text: str, own: np.ndarray, after: str, after_print: np.ndarray) -> tuple:
    other = edited(text, after)
    changed = own if other == text else fingerprint(other)
    return doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), own.tobytes().hex(), changed.tobytes().hex(), likeness(own, changed), likeness(own, after_print)


RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
EDGE = ["edge", "part", "text"]


def record_batch(done: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
    """Results, then edge rows: (edge, part, doc_id, text) and nothing else."""
    rows = [(*x, None, None, None) for x in done] + [(d, None, None, None, None, None, None, e, p, t) for e, p, d, t in edges]
    cols = list(zip(*rows))
    kinds = [*TYPES, pa.int32(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[*RESULT, *EDGE])


FIRST, LAST = 0, 1


def ordered_prints(batches):
    """mapInArrow over a range of documents in order: results of all but the
    last document, whose text goes out as an edge row like the first one's."""
    part = TaskContext.get().partitionId()
    held = None
    with np.errstate(over="ignore"):
        for batch in batches:
            done, edges = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                own = fingerprint(text)
                if held is None:
                    edges.append((FIRST, part, doc_id, text))
                else:
                    done.append(result(*held, text, own))
                held = doc_id, text, own
            if done or edges:
                yield record_batch(done, edges)
        if held is not None:
            yield record_batch([], [(LAST, part, held[0], held[1])])


def edge_prints(batches):
    """mapInArrow: a range's last documents with the text after each."""
    with np.errstate(over="ignore"):
        for batch in batches:
            done = [result(d, t, fingerprint(t), a, fingerprint(a)) for d, t, a in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "after")))]
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), TYPES)], names=RESULT)


def order_prints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every row of ``docs`` (doc_id, text).

    The documents stand in ascending doc_id (null first; rows of one doc_id by
    a hash of their text), the first follows the last. The edited text is the
    text with its last floor(n_chars / 4) code points replaced by the first as
    many (or all) of the next document. A null text counts as empty; a single
    document is its own next one; an empty table gives no rows. Other columns
    are not read.

    The texts are shuffled once, by ranges of doc_id; a task sees its range in
    order and only one document of each range waits for the next range's first.
    """
    spark = docs.sparkSession
    with arrow_settings(spark):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
        rows = rows.repartitionByRange(partitions(spark), "doc_id", "_h").sortWithinPartitions("doc_id", "_h")
        done = stage(rows.select("doc_id", "text").mapInArrow(ordered_prints, f"{FIELDS}, edge int, part int, text string"), "prints")
        edges = done.filter("edge is not null").select("edge", "part", "doc_id", "text")
        # ranges are few; each is followed by the next one that has documents, the last one by the first
        parts = [r.part for r in edges.filter(F.col("edge") == FIRST).select("part").orderBy("part").collect()]
        follow = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]])), "part int, next int")
        last = edges.filter(F.col("edge") == LAST).join(follow, "part")
        first = edges.filter(F.col("edge") == FIRST).select(F.col("part").alias("next"), F.coalesce("text", F.lit("")).alias("after"))
        tail = last.join(first, "next").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "after").mapInArrow(edge_prints, FIELDS)
        out = stage(done.filter("edge is null").select(*RESULT).unionByName(tail), "order_prints")
        drop_stage(done)
        return out


def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_prints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
