"""Exact top-k inner products by norm buckets.

Candidates are grouped by length (each bucket's shortest vector has at least
nine tenths of its longest) and a bucket is dealt by id over blocks of bounded
size. A first pass over the longest blocks gives each query a score that its
k-th best reaches at least. For each bucket this becomes a local cosine
threshold: above 1 the bucket is skipped; a high one prunes by the query's
largest coordinates, a low one by length alone. What is left is multiplied out.

Components are integers, so products below 2**53 are exact in double
precision; longer vectors are multiplied as integers.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickcast.llm.common import arrow_settings, drop_stage, stage

RATIO = 0.9  # of norms in a bucket
BLOCK = 4096  # candidates
QUERIES = 512  # queries in a block
FOCUS = 8  # coordinates looked at first
STEEP = 0.8  # local cosine from which coordinates prune better than length
LOWEST = np.iinfo(np.int64).min


def pack_block(pdf: pd.DataFrame) -> tuple[bytes, bytes, int]:
    ids = pdf["vec_id"].to_numpy(np.int64)
    width = max((len(v) for v in pdf["v"]), default=0)
    table = np.zeros((len(ids), width), np.int64)
    for i, v in enumerate(pdf["v"]):
        table[i, : len(v)] = v
    order = np.lexsort((ids, -np.sqrt((table.astype(float) ** 2).sum(1))))
    return ids[order].tobytes(), table[order].tobytes(), width


def packed(pdf: pd.DataFrame) -> pd.DataFrame:
    ids, table, width = pack_block(pdf)
    return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "ids": [ids], "vecs": [table], "width": [width]})


PACKED = "block long, ids binary, vecs binary, width int"


def unpacked(ids: bytes, vecs: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(vecs, np.int64).reshape(len(ids), width)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products (shorter vectors padded with zeros)."""
    w = min(q.shape[1], c.shape[1])
    q, c = q[:, :w], c[:, :w]
    big = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(w, 1)
    if big < 2**53:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return q @ c.T


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, ties to the smaller id."""
    if len(score) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        keep = np.flatnonzero(score >= edge)
    else:
        keep = np.arange(len(score))
    return keep[np.lexsort((ids[keep], -score[keep]))][:k]


def block_top(qid, q, floor, cid, c, k):
    """(query_id, vec_id, score) of a block's best for each query, at least ``floor``."""
    qn, cn = np.sqrt((q.astype(float) ** 2).sum(1)), np.sqrt((c.astype(float) ** 2).sum(1))
    out = []
    top = cn[0] if len(cn) else 0.0
    w = min(q.shape[1], c.shape[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(qn * top > 0, floor / (qn * top), np.where(floor > 0, np.inf, -np.inf))
    skip = cosine > 1 + 1e-9
    by_coord = ~skip & (cosine > STEEP)
    unit = c[:, :w] / np.where(cn > 0, cn, 1)[:, None] if by_coord.any() else None
    whole = np.flatnonzero(~skip & ~by_coord)
    table = products(q[whole], c) if len(whole) else None
    for row, i in enumerate(whole):
        # length: scores of shorter candidates stay below the floor
        n = len(cn) if floor[i] <= 0 else int(np.searchsorted(-cn, -(floor[i] / max(qn[i], 1e-300)) * (1 - 1e-9), "right"))
        pick = np.flatnonzero(cid[:n] != qid[i])
        score = table[row, pick]
        good = score >= floor[i]
        at = best(score[good], cid[pick[good]], k)
        out.append((np.full(len(at), qid[i]), cid[pick[good]][at], score[good][at]))
    for i in np.flatnonzero(by_coord):
        u = q[i, :w] / qn[i]
        focus = np.argsort(-np.abs(u))[:FOCUS]
        part = unit[:, focus]
        bound = part @ u[focus] + np.sqrt(max(0.0, 1 - (u[focus] ** 2).sum())) * np.sqrt(np.maximum(0, 1 - (part**2).sum(1)))
        pick = np.flatnonzero((bound * cn * qn[i] >= floor[i] * (1 - 1e-9) - 1e-6) & (cid != qid[i]))
        score = products(q[i : i + 1], c[pick])[0] if len(pick) else np.zeros(0, np.int64)
        good = score >= floor[i]
        at = best(score[good], cid[pick[good]], k)
        out.append((np.full(len(at), qid[i]), cid[pick[good]][at], score[good][at]))
    return out


def scan(k: int):
    """mapInArrow over (query block, candidate block) rows."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qid, q = unpacked(r["q_ids"], r["q_vecs"], r["q_width"])
                floor = np.frombuffer(r["floor"], np.int64) if r["floor"] else np.full(len(qid), LOWEST)
                cid, c = unpacked(r["ids"], r["vecs"], r["width"])
                found = block_top(qid, q, floor.astype(float), cid, c, k)
                if found:
                    cols = [np.concatenate(x).astype(np.int64) for x in zip(*found)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["query_id", "vec_id", "score"])

    return run


def visits(buckets: list[tuple[int, float, int, int]], first: int):
    """mapInArrow: query blocks -> a row for each candidate block they must visit.

    ``buckets``: (number, longest norm, first block, blocks), longest first;
    blocks below ``first`` were visited before.
    """

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                _, q = unpacked(r["q_ids"], r["q_vecs"], r["q_width"])
                qn = np.sqrt((q.astype(float) ** 2).sum(1))
                floor = np.frombuffer(r["floor"], np.int64)
                for _, top, low, n in buckets:
                    if (floor <= qn * top * (1 + 1e-9) + 1e-6).any():
                        rows += [r | {"block": b} for b in range(max(low, first), low + n)]
                while len(rows) >= 64:
                    yield pa.RecordBatch.from_pylist(rows[:64], VISIT)
                    rows = rows[64:]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, VISIT)

    return run


VISIT = pa.schema([("q_ids", pa.binary()), ("q_vecs", pa.binary()), ("q_width", pa.int32()), ("floor", pa.binary()), ("block", pa.int64())])
VISIT_DDL = "q_ids binary, q_vecs binary, q_width int, floor binary, block long"


def with_floor(k: int):
    """applyInPandas (cogroup): a query block and its first scores -> its floors."""

    def run(blocks: pd.DataFrame, scores: pd.DataFrame) -> pd.DataFrame:
        out = []
        kth = scores[scores["i"] == k].set_index("query_id")["score"] if len(scores) else {}
        for r in blocks.itertuples():
            ids = np.frombuffer(r.ids, np.int64)
            floor = np.array([int(kth.get(x, LOWEST)) for x in ids], np.int64)
            out.append((r.ids, r.vecs, r.width, floor.tobytes()))
        return pd.DataFrame(out, columns=["q_ids", "q_vecs", "q_width", "floor"])

    return run


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of vectors without null or
    non-finite components; the others, and null ids, take no part."""
    x = F.col("embedding")
    ok = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return vectors.filter(ok).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long")).alias("v"))


def top_k(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of
    each query row against all rows of other ids in ``vectors`` (vec_id, v).

    Ties go to the smaller vec_id; fewer candidates give fewer rows; rows
    repeated with one id are candidates each. Vectors of unequal lengths are
    padded with zeros. No vectors or no queries give an empty result.
    """
    spark = vectors.sparkSession
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e))
    bucket = F.when(F.col("norm") > 0, F.floor(-F.log("norm") / F.lit(-float(np.log(RATIO)))).cast("int")).otherwise(F.lit(2**31 - 1))
    rows = stage(vectors.withColumn("norm", norm).withColumn("bucket", bucket), "vectors")
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top")).orderBy("bucket").collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    buckets, at = [], 0
    for r in sizes:  # buckets are powers of RATIO: as many as the norms' magnitudes allow
        n = -(-r["n"] // BLOCK)
        buckets.append((r["bucket"], float(r["top"]), at, n))
        at += n
    first, seen = 0, 0
    for r, b in zip(sizes, buckets):
        if seen >= BLOCK:
            break
        first, seen = b[2] + 1, seen + r["n"] // b[3]
    low = F.create_map(*[F.lit(x) for b, _, a, _ in buckets for x in (b, a)])
    many = F.create_map(*[F.lit(x) for b, _, _, n in buckets for x in (b, n)])
    block = (low[F.col("bucket")] + F.pmod(F.xxhash64("vec_id", "v"), many[F.col("bucket")])).cast("long").alias("block")
    cand = stage(rows.select(block, "vec_id", "v").groupBy("block").applyInPandas(packed, PACKED), "blocks")
    queries = rows.filter(is_query).select("vec_id", "v")
    n_query = max(1, -(-queries.count() // QUERIES))
    of_query = F.pmod(F.xxhash64("vec_id"), F.lit(n_query)).cast("long")
    qblocks = stage(queries.withColumn("block", of_query).select("block", "vec_id", "v").groupBy("block").applyInPandas(packed, PACKED), "queries")
    as_query = qblocks.select(F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs"), F.col("width").alias("q_width"))

    found = "query_id long, vec_id long, score long"
    start = as_query.withColumn("floor", F.lit(None).cast("binary")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(first - 1)))).withColumn("block", F.col("block").cast("long"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    head = stage(start.join(cand, "block").mapInArrow(scan(k), found), "head")
    kth = head.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= k)
    kth = kth.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_query)).cast("long"))
    floors = qblocks.groupBy("block").cogroup(kth.groupBy("block")).applyInPandas(with_floor(k), "q_ids binary, q_vecs binary, q_width int, floor binary")
    tail = floors.mapInArrow(visits(buckets, first), VISIT_DDL).join(cand, "block").mapInArrow(scan(k), found)
    ranked = head.unionByName(tail).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    out = stage(ranked.select("query_id", "rank", "vec_id", "score"), "topk")
    for x in (rows, cand, qblocks, head):
        drop_stage(x)
    return out


def op6_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    with arrow_settings(spark):
        return top_k(quantised(vectors), F.col("vec_id") % 20 == 0)
