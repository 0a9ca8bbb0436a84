"""Shared helpers: staged tables, Arrow text access, 64-bit mixing, components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickcast.session import checkpoint_dir, scratch_path, session_conf, ship_package

U64 = np.uint64

#: Small Arrow batches bound a Python worker's memory whatever the text lengths.
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


@contextmanager
def arrow_settings(spark: SparkSession):
    checkpoint_dir(spark)
    ship_package(spark)
    with session_conf(spark, ARROW):
        yield


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: lineage
    is cut and a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def drop_stage(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.stage_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    """Reduce-side partitions; the session sizes them to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null as empty) and the row offsets."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    if data is None:
        return np.zeros(0, np.uint8), off - off[0]
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (invertible, well spread high and low bits)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_POW: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept per worker."""
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length()) if n > 1 else 1024
        have = np.full(size, base, U64)
        have[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(have, out=have)
        _POW[base] = have
    return have[:n]


def byte_codes(seed: int) -> np.ndarray:
    """A random odd 64-bit code for each byte value."""
    return mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15 + 2 * seed)) | U64(1)


def record_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def ranked(df: DataFrame, value: str, ties: list[str], buckets: int) -> DataFrame:
    """``df`` with ``rank``: 0, 1, ... among the rows of equal ``value``.

    Rows are numbered within (bucket, value); the buckets' counts give the
    numbers before. A value that many rows share is split over all buckets.
    """
    df = df.withColumn("_b", F.pmod(F.xxhash64(*ties), F.lit(buckets)).cast("int"))
    counts = df.groupBy(value, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(W.partitionBy(value).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)))
    own = df.withColumn("_own", F.row_number().over(W.partitionBy("_b", value).orderBy(*ties)))
    return own.join(before.drop("_n"), [value, "_b"]).withColumn("rank", F.coalesce("_before", F.lit(0)) + F.col("_own") - 1).drop("_b", "_own", "_before")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (a, b).

    Alternating large-star and small-star steps; each is a grouped minimum
    and one join, so a hub is pre-aggregated and never gathered in a task.
    Every step is written to the shared folder; the loop ends when the edge
    set is a forest of stars that no longer changes.
    """
    spark = edges.sparkSession
    cur = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(),
        "cc",
    )

    def sign(df: DataFrame):
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    seen = sign(cur)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        nxt = stage(small.filter("u != v").distinct(), "cc")
        now = sign(nxt)
        drop_stage(cur)
        cur = nxt
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    star = cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return star.unionAll(star.select(F.col("component").alias("node"), "component").distinct()).distinct()


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True):
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts: (hash, row, first byte, end).

    ``lower`` maps A-Z first. The 64-bit hash covers the word's bytes.
    """
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    inside = (data != 32) & ((data < 9) | (data > 13))
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = off[:-1][np.diff(off) > 0]
    begin[heads] = inside[heads]
    start = np.flatnonzero(begin)
    if not len(start):
        none = np.zeros(0, np.int64)
        return np.zeros(0, U64), none, none, none
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    tails = off[1:][np.diff(off) > 0] - 1
    stop[tails] = inside[tails]
    end = np.flatnonzero(stop) + 1
    return byte_hashes(data, start, end - start), np.searchsorted(off, start, "right") - 1, start, end


LANES = 8  # words of up to so many 8-byte lanes are hashed in rounds, longer ones one by one


def byte_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of ``data``: eight bytes at a time go through
    a full mixing step, so that no regular pattern of bytes cancels out."""
    pad = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.lib.stride_tricks.sliding_window_view(pad, 8)
    out = mix(size.astype(U64) + U64(0x9E3779B97F4A7C15))
    todo = np.flatnonzero(size <= 8 * LANES)
    with np.errstate(over="ignore"):
        for k in range(LANES):
            todo = todo[size[todo] > 8 * k]
            if not len(todo):
                break
            lane = np.ascontiguousarray(lanes[start[todo] + 8 * k]).view("<u8").ravel()
            left = np.minimum(size[todo] - 8 * k, 8).astype(U64)
            lane &= U64(0xFFFFFFFFFFFFFFFF) >> (U64(64) - U64(8) * left)
            out[todo] = mix((out[todo] ^ lane) * U64(0xC2B2AE3D27D4EB4F) + U64(k + 1))
    for i in np.flatnonzero(size > 8 * LANES):
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : start[i] + size[i]].tobytes(), 29)
    return out


def shingle_sets(data: np.ndarray, off: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its k-word shingles; a text of
    fewer words has its whole sequence as one, a text without words none."""
    h, row, _, _ = word_hashes(data, off)
    n = np.bincount(row, minlength=len(off) - 1)
    first = np.cumsum(n) - n
    with np.errstate(over="ignore"):
        s = np.zeros(max(0, len(h) - k + 1), U64)
        for i in range(k):
            s += mix(h[i : len(h) - k + 1 + i] + U64(i + 1)) * U64(2 * i + 1)
        s = mix(s)
        out = []
        for a, c in zip(first, n):
            if c >= k:
                out.append(np.unique(s[a : a + c - k + 1]))
            elif c:
                code = U64(c)
                for x in h[a : a + c]:
                    code = mix(np.array([code * U64(0xC2B2AE3D27D4EB4F) + x], U64))[0]
                out.append(np.array([code], U64))
            else:
                out.append(np.zeros(0, U64))
    return out
