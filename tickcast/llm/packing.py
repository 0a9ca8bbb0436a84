"""Best-fit packing by linear grouping.

Pieces longer than a quarter of the capacity are large. Sorted by length and
cut into groups of equal cardinality, each is rounded up to the longest of its
group, which leaves few sizes. Configurations are chosen for those sizes: the
longest size left is completed by the fullest combination of the others (an
exact subset-sum over the sizes and their counts) and used as often as the
counts allow. Real pieces then take the places of their group, and the small
pieces go, longest first, into the fullest sequence that still holds them.

The driver plans on histograms of at most ``capacity`` lengths; pieces and
sequences stay in Spark, where a piece finds its place by its rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickcast.llm.bpe import encoder, vocabulary
from tickcast.llm.common import arrow_settings, drop_stage, partitions, ranked, stage

CAPACITY = 2048
GROUPS = 1024
PIECE = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def pieces_of(path: str, capacity: int, end_id: int, with_ids: bool):
    """mapInArrow: documents -> their token pieces, each with a number of its own."""

    def run(batches):
        enc = encoder(path)
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            docs = batch.column("doc_id").to_pylist()
            rows, flat = [], []
            for doc, ids in zip(docs, enc.encode(batch.column("text").to_pylist())):
                ids = np.append(ids, end_id).astype("<u4")
                for i, (s, n) in enumerate(cut(len(ids), capacity)):
                    own = ids[s : s + n]
                    rows.append((uid, doc, i, s, n, zlib.crc32(own.tobytes())))
                    uid += 1
                    if with_ids:
                        flat.append(own.astype(np.int32))
            if not rows:
                continue
            cols = [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                off = np.append(0, np.cumsum([len(x) for x in flat])).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(flat))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(pieces_of(path, capacity, end_id, with_ids), PIECE + (", ids array<int>" if with_ids else ""))


def fullest(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[int]:
    """Indexes (with repeats) of the sizes whose sum fills ``room`` best."""
    by = np.full(room + 1, -1, np.int32)  # the size that reached each sum
    used = np.zeros(room + 1, np.int32)  # how many of that size it holds
    by[0] = len(sizes)
    for i, (s, c) in enumerate(zip(sizes, counts)):
        if c <= 0 or s > room:
            continue
        used[:] = 0
        for k in range(min(int(c), room // int(s))):
            src = np.flatnonzero((by[: room + 1 - s] >= 0) & (by[s:] < 0) & (used[: room + 1 - s] == k))
            if not len(src):
                break
            by[src + s] = i
            used[src + s] = k + 1
    at = int(np.flatnonzero(by >= 0)[-1])
    out = []
    while at:
        out.append(int(by[at]))
        at -= int(sizes[by[at]])
    return out


def plan_large(hist: dict[int, int], capacity: int, groups: int) -> tuple[np.ndarray, int]:
    """Rows (first rank, first sequence, sequences) by rank, and the sequence count.

    Ranks number the large pieces from the longest; the piece of rank r in a
    row goes to sequence first + (r - first rank) % sequences.
    """
    lengths = np.array(sorted(hist, reverse=True), np.int64)
    counts = np.array([hist[x] for x in lengths], np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros((0, 3), np.int64), 0
    each = -(-total // groups)
    firsts = np.arange(0, total, each)
    sizes = lengths[np.searchsorted(np.cumsum(counts), firsts, "right")]
    left = np.minimum(each, total - firsts)
    taken = np.zeros(len(firsts), np.int64)
    rows, n_seq = [], 0
    while left.any():
        lead = int(np.argmax(left > 0))
        rest = left.copy()
        rest[lead] -= 1
        config = [lead, *fullest(sizes, rest, capacity - int(sizes[lead]))]
        need = np.bincount(config, minlength=len(sizes))
        some = np.flatnonzero(need)
        times = int((left[some] // need[some]).min())
        for g in some:
            rows.append((int(firsts[g] + taken[g]), n_seq, times))
            taken[g] += need[g] * times
            left[g] -= need[g] * times
        n_seq += times
    rows.sort()
    return np.array(rows, np.int64), n_seq


def plan_small(hist: dict[int, int], room: dict[int, int], capacity: int, n_seq: int) -> tuple[np.ndarray, int]:
    """Best fit of the small lengths into ``room`` (residual -> sequences).

    Rows (first rank, residual, first rank in that residual, count); residual
    -1 stands for new sequences, whose rank is then the sequence number.
    """
    open_: dict[int, list[tuple[int, int, int]]] = {r: [(r, 0, c)] for r, c in room.items() if r > 0 and c}
    order = sorted(open_)
    rows, rank = [], 0
    for s in sorted(hist, reverse=True):
        todo = hist[s]
        while todo:
            at = bisect_left(order, s)
            if at == len(order):
                n = -(-todo // (capacity // s))
                open_.setdefault(capacity, []).append((-1, n_seq, n))
                if capacity not in order:
                    insort(order, capacity)
                n_seq += n
                continue
            r = order[at]
            src, low, n = open_[r].pop()
            t = min(n, todo)
            if n > t:
                open_[r].append((src, low + t, n - t))
            if not open_[r]:
                del open_[r]
                order.pop(at)
            rows.append((rank, src, low, t))
            if r > s:
                if r - s not in open_:
                    open_[r - s] = []
                    insort(order, r - s)
                open_[r - s].append((src, low, t))
            rank += t
            todo -= t
    return np.array(rows, np.int64).reshape(-1, 4), n_seq


def histogram(df: DataFrame, key: str) -> dict[int, int]:
    """Counts by a value of at most CAPACITY kinds."""
    return {int(k): int(n) for k, n in df.groupBy(key).count().collect()}


def above(hist: dict[int, int], capacity: int) -> np.ndarray:
    """For each length the number of longer pieces in ``hist``."""
    n = np.zeros(capacity + 2, np.int64)
    for k, v in hist.items():
        n[k] = v
    return np.append(np.cumsum(n[::-1])[::-1][1:], 0)


def place_large(plan: np.ndarray, longer: np.ndarray):
    def run(pdfs):
        for pdf in pdfs:
            r = longer[pdf["length"].to_numpy()] + pdf["rank"].to_numpy()
            row = plan[np.searchsorted(plan[:, 0], r, "right") - 1]
            yield pd.DataFrame({"uid": pdf["uid"], "length": pdf["length"], "sequence_id": row[:, 1] + (r - row[:, 0]) % row[:, 2]})

    return run


def place_small(plan: np.ndarray, longer: np.ndarray):
    def run(pdfs):
        for pdf in pdfs:
            r = longer[pdf["length"].to_numpy()] + pdf["rank"].to_numpy()
            row = plan[np.searchsorted(plan[:, 0], r, "right") - 1]
            yield pd.DataFrame({"uid": pdf["uid"], "length": pdf["length"], "room": row[:, 1], "rank": row[:, 2] + r - row[:, 0]})

    return run


def assign(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """(uid, sequence_id, offset) of every piece (uid, length); lengths lie in
    1 to ``capacity``. Pieces of a sequence follow one another from offset 0.
    An empty table gives an empty result."""
    spark = pieces.sparkSession
    buckets = partitions(spark)
    pieces = stage(ranked(pieces.select("uid", "length"), "length", ["uid"], buckets), "ranked")
    hist = histogram(pieces, "length")
    small_max = capacity // 4
    large = {k: v for k, v in hist.items() if k > small_max}
    small = {k: v for k, v in hist.items() if k <= small_max}
    plan, n_seq = plan_large(large, capacity, groups)
    schema = "uid long, length long, sequence_id long"
    placed = pieces.filter(F.col("length") > small_max).mapInPandas(place_large(plan, above(large, capacity)), schema)
    placed = stage(placed, "large")
    bins = placed.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("room")).filter("room > 0")
    bins = stage(ranked(bins, "room", ["sequence_id"], buckets), "rooms")
    plan, _ = plan_small(small, histogram(bins, "room"), capacity, n_seq)
    rest = pieces.filter(F.col("length") <= small_max).mapInPandas(place_small(plan, above(small, capacity)), "uid long, length long, room long, rank long")
    rest = rest.join(bins, ["room", "rank"], "left").select("uid", "length", F.when(F.col("room") < 0, F.col("rank")).otherwise(F.col("sequence_id")).alias("sequence_id"))
    order = W.partitionBy("sequence_id").orderBy(F.desc("length"), "uid")
    both = placed.unionByName(rest).withColumn("offset", F.sum("length").over(order) - F.col("length"))
    out = stage(both.select("uid", "sequence_id", "offset"), "assigned")
    for x in (pieces, placed, bins):
        drop_stage(x)
    return out


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """The pieces of ``docs`` (doc_id, text) with their sequence and offset and,
    with ``with_ids``, their token ids. A null text is empty and still gives its
    end id; repeated rows are packed each; other columns are not read."""
    with arrow_settings(docs.sparkSession):
        pieces = stage(token_pieces(docs, path, capacity, end_id, with_ids), "pieces")
        places = assign(pieces, capacity)
        out = stage(pieces.join(places, "uid").drop("uid"), "packed")
        drop_stage(pieces)
        drop_stage(places)
        return out


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, vocabulary(), with_ids=False)
