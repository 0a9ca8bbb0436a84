"""Alignment of two tokenizers by diagonal run skipping.

Both tokenizations of a text are arrays of byte ends. While tokens stand one
to one, the ends of B lie at a fixed index shift from those of A: exponential
probing compares growing stretches of the two arrays at that shift, a halving
search finds where they part, and the whole stretch is jumped. The irregular
group that follows is resolved locally, token by token, up to the next common
end; that gives the new shift. Walking a group also gives its links: the pairs
of tokens whose byte ranges overlap.

Corpus-wide counts of linked id pairs are sums in Spark. Tasks count blocks of
texts; a block's distinct pairs, numbered by falling frequency, are its
dictionary, and each document keeps its links as gaps between these numbers.
Totals come back to a block as one row a distinct pair, not one a link.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.llm.bpe import encoder, spread
from tickcast.llm.common import arrow_settings, drop_stage, stage

BLOCK = 10 << 20  # characters of a block
WINDOW = 1 << 16  # tokens held as Python numbers at once
BLOCKS = 1 << 24  # block numbers of a task


class Pieces:
    """A sentencepiece model and the bytes of its pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.raw = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.raw.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.size = np.array([len(x) for x in self.raw], np.int64)
        self.flat = np.frombuffer(b"".join(self.raw), np.uint8)
        self.at = np.cumsum(self.size) - self.size

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return self.flat[spread(self.at[ids], self.size[ids])].tobytes()


@lru_cache(2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def probe(ea: list[int], eb: list[int], i: int, j: int) -> int:
    """How many ends from i and j on are equal one to one (the first ones are)."""
    i += 1
    j += 1
    begin, size = i, 4
    while (a := ea[i : i + size]) and a == eb[j : j + size]:
        i += len(a)
        j += len(a)
        size *= 2
    while size > 16:
        size //= 2
        if (a := ea[i : i + size]) and a == eb[j : j + size]:
            i += len(a)
            j += len(a)
    for x, y in zip(ea[i : i + size], eb[j : j + size]):
        if x != y:
            break
        i += 1
    return i - begin + 1


def align_window(ea: list[int], eb: list[int], runs: list, cuts: list, links: list) -> tuple[int, int]:
    """Align as far as whole groups reach: one-to-one stretches go to ``runs``
    (place in A, in B, tokens), ends and links of irregular groups to ``cuts``
    and ``links`` (A and B in turn). Gives the tokens of A and B aligned."""
    n, m = len(ea), len(eb)
    i = j = 0
    while i < n and j < m:
        x, y = ea[i], eb[j]
        if x == y:
            run = probe(ea, eb, i, j)
            runs += (i, j, run)
            i += run
            j += run
            continue
        # an irregular group: up to the next common end
        a, b, had = i, j, len(links)
        while x != y:
            links += (a, b)
            if x < y:
                a += 1
                if a == n:
                    break
                x = ea[a]
            else:
                b += 1
                if b == m:
                    break
                y = eb[b]
        if x != y:  # the window ends inside the group
            del links[had:]
            break
        links += (a, b)
        i, j = a + 1, b + 1
        cuts += (i, j)
    return i, j


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(cuts in A, cuts in B, link tokens of A, of B): a cut is the number of
    tokens up to a common end. Both arrays rise and end at the same byte."""
    found: list[tuple] = []
    i = j = 0
    width = WINDOW
    while i < len(ends_a):
        runs, cuts, links = [], [], []
        di, dj = align_window(ends_a[i : i + width].tolist(), ends_b[j : j + width].tolist(), runs, cuts, links)
        at, own, odd = (np.array(x, np.int64).reshape(-1, k) for x, k in ((runs, 3), (cuts, 2), (links, 2)))
        inner = np.arange(at[:, 2].sum()) - np.repeat(np.cumsum(at[:, 2]) - at[:, 2], at[:, 2])
        one_a, one_b = (np.repeat(at[:, k], at[:, 2]) + inner for k in (0, 1))
        found.append((np.sort(np.concatenate([own[:, 0], one_a + 1])) + i, np.sort(np.concatenate([own[:, 1], one_b + 1])) + j, np.concatenate([one_a, odd[:, 0]]) + i, np.concatenate([one_b, odd[:, 1]]) + j))
        width = WINDOW if di else 2 * width  # a group longer than the window
        i, j = i + di, j + dj
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4


def groups_text(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, words: np.ndarray, n_a: int, n_b: int) -> str:
    """``a1,a2|b1;a3|b2,b3``. ``words`` holds ids with , and | of A, then with , and ; of B."""
    size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    place_a = np.arange(len(a)) + np.repeat(cut_b - size_b, size_a)
    place_b = np.arange(len(b)) + np.repeat(cut_a, size_b)
    word_a, word_b = a.astype(np.int64), b.astype(np.int64) + 2 * n_a
    word_a[cut_a - 1] += n_a
    word_b[cut_b - 1] += n_b
    flat = np.empty(len(a) + len(b), np.int64)
    flat[place_a], flat[place_b] = word_a, word_b
    return "".join(words.take(flat).tolist())[:-1]


def varints(v: np.ndarray) -> bytes:
    """Seven bits a byte, low ones first; the last byte of a number is below 128."""
    v = v.astype(np.int64)
    size = np.ones(len(v), np.int64)
    for bits in (7, 14, 21, 28, 35):
        size += v >> bits > 0
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max()) if len(v) else 0):
        pick = size > k
        out[at[pick] + k] = (v[pick] >> (7 * k)) & 127 | np.where(size[pick] > k + 1, 128, 0)
    return out.tobytes()


def numbers(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, data[:-1] < 128))
    size = np.diff(np.append(first, len(data)))
    inner = np.arange(len(data)) - np.repeat(first, size)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * inner), first)


def pack_links(number: np.ndarray) -> bytes:
    """Distinct dictionary numbers as gaps; those met more than once are
    flagged, and their further occurrences follow as a second list."""
    own, count = np.unique(number, return_counts=True)
    gaps = np.diff(own, prepend=-1) * 2 + (count > 1)
    return varints(np.concatenate([[len(own)], gaps, count[count > 1] - 2]))


def unpack_links(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    v = numbers(raw)
    n = int(v[0]) if len(v) else 0
    gaps = v[1 : n + 1]
    count = np.ones(n, np.int64)
    count[gaps & 1 == 1] = v[n + 1 :] + 2
    return np.cumsum(gaps >> 1) - 1, count


BLOCK_ROWS = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, number int, pair long, n long"
ROW_TYPES = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
ROW_NAMES = [x.split()[0] for x in BLOCK_ROWS.split(", ")]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a), pieces(path_b)
        self.n_a, self.n_b = len(self.a.raw_len), len(self.b.size)
        ids = [str(i) for i in range(max(self.n_a, self.n_b))]
        self.words = np.array([x + end for n, ends in ((self.n_a, ",|"), (self.n_b, ",;")) for end in ends for x in ids[:n]], object)

    def documents(self, texts: list[str]):
        """Of each text (n_a, n_b, n_groups, sha, linked pairs); None without tokens."""
        spaced = [" " + t for t in texts]
        flat, count = self.a.encode_plain(spaced)
        for text, ids_a, ids_b in zip(spaced, np.split(flat, np.cumsum(count)[:-1]), self.b.encode(texts)):
            raw, ids_b = text.encode(), np.array(ids_b, np.int64)
            if len(text) == 1 or self.a.decode_bytes(ids_a) != raw or self.b.decode_bytes(ids_b) != raw:
                yield None
                continue
            cut_a, cut_b, link_a, link_b = align(np.cumsum(self.a.raw_len[ids_a]), np.cumsum(self.b.size[ids_b]))
            sha = hashlib.sha256(groups_text(ids_a, ids_b, cut_a, cut_b, self.words, self.n_a, self.n_b).encode()).hexdigest()
            yield len(ids_a), len(ids_b), len(cut_a), sha, ids_a[link_a].astype(np.int64) * self.n_b + ids_b[link_b]

    def block(self, number: int, doc_ids: list, done: list):
        """The record batches of a block: documents, then its distinct pairs."""
        none = np.zeros(0, np.int64)
        pairs = np.concatenate([x[4] if x else none for x in done] or [none])
        named = pa.array(pairs).dictionary_encode()
        own, place = named.dictionary.to_numpy(), named.indices.to_numpy()
        count = np.bincount(place, minlength=len(own))
        order = np.argsort(-count, kind="stable")
        rank = np.empty(len(own), np.int64)
        rank[order] = np.arange(len(own))
        links = np.split(rank[place], np.cumsum([len(x[4]) if x else 0 for x in done])[:-1])
        rows = [(number, d, x[0], x[1], x[2], len(x[4]), x[3], pack_links(y)) if x else (number, d, 0, 0, 0, 0, "", None) for d, x, y in zip(doc_ids, done, links)]
        for s in range(0, len(rows), 1024):
            part = rows[s : s + 1024]
            cols = [pa.array(c, k) for c, k in zip(zip(*part), ROW_TYPES)] + [pa.nulls(len(part), k) for k in ROW_TYPES[8:]]
            yield pa.RecordBatch.from_arrays(cols, names=ROW_NAMES)
        for s in range(0, len(own), 1 << 16):
            part = order[s : s + (1 << 16)]
            cols = [pa.array(np.full(len(part), number))] + [pa.nulls(len(part), k) for k in ROW_TYPES[1:8]]
            cols += [pa.array(np.arange(s, s + len(part), dtype=np.int32)), pa.array(own[part]), pa.array(count[part])]
            yield pa.RecordBatch.from_arrays(cols, names=ROW_NAMES)


@lru_cache(2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def aligned_blocks(path_a: str, path_b: str):
    """mapInArrow: (doc_id, text) -> BLOCK_ROWS."""

    def run(batches):
        own = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() * BLOCKS
        ids, done, size = [], [], 0
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = [x or "" for x in batch.column("text").to_pylist()]
                ids += batch.column("doc_id").to_pylist()
                done += own.documents(texts) if texts else []
                size += sum(map(len, texts))
                if size >= BLOCK:
                    yield from own.block(number, ids, done)
                    number, ids, done, size = number + 1, [], [], 0
            if ids:
                yield from own.block(number, ids, done)

    return run


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def with_counts(docs: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
    """A block's documents with the corpus-wide counts of their links."""
    worth = np.zeros(len(totals), np.int64)
    worth[totals["number"].to_numpy()] = totals["worth"].to_numpy()
    best, total = [], []
    for raw in docs["links"]:
        number, count = unpack_links(raw or b"")
        best.append(int((count * (worth[number] & 1)).sum()))
        total.append(int((count * (worth[number] >> 1)).sum()))
    return docs.assign(n_best=best, count_sum=total)[[x.split()[0] for x in RESULT.split(", ")]]


def align_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """RESULT of every row of ``docs`` (doc_id, text).

    A encodes a blank and the text, B the text (it adds the blank); special
    tokens' strings are plain text. Groups lie between byte offsets at which
    tokens of both end. A text that is null, empty or not rebuilt by the bytes
    of both tokenizers has no tokens: zeros and an empty digest. Repeated rows
    count each time; a null doc_id stays null. Other columns are not read. An
    empty table gives no rows.
    """
    spark = docs.sparkSession
    with arrow_settings(spark):
        n_b = pieces(path_b).model.get_piece_size()
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        rows = stage(rows.mapInArrow(aligned_blocks(path_a, path_b), BLOCK_ROWS), "aligned")
        pairs = rows.filter("pair is not null").select("block", "number", "pair", "n")
        counts = pairs.groupBy("pair").agg(F.sum("n").alias("c")).withColumn("b", F.col("pair") % n_b)
        counts = stage(counts, "pair_counts")
        top = F.broadcast(counts.groupBy("b").agg(F.max("c").alias("top")))  # one row an id of B at most
        worth = counts.join(top, "b").select("pair", (F.col("c") * 2 + (F.col("c") == F.col("top")).cast("long")).alias("worth"))
        totals = pairs.join(worth, "pair").select("block", "number", "worth")
        known = spark.read.schema(rows.schema).parquet(rows.stage_path).filter("pair is null").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")
        out = stage(known.groupBy("block").cogroup(totals.groupBy("block")).applyInPandas(with_counts, RESULT), "alignment")
        drop_stage(rows)
        drop_stage(counts)
        return out


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
