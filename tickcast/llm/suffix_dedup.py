"""Suffix-array dedup with a logarithmic index family.

Every 100-byte window of a text belongs to one anchor: the position in it
whose 32-byte block has the smallest hash (leftmost on ties), which depends
on the window's bytes alone. The windows of one anchor are consecutive; the
text they span is one suffix entry. A batch's suffix array is the entries
sorted by (block hash, span hash, order), cut into key parts. It is
merge-scanned against every level; levels hold one entry for each distinct
span, the earliest, and merge like the digits of a binary counter, so an
entry is rewritten a logarithmic number of times.

An entry whose span hash occurs earlier is repeated as a whole. Entries that
share a block but not the span are read again from the text and compared
window by window, so partial matches are found to the byte. Their windows are
dealt by the window's hash, after each map task has kept the earliest of each,
so neither a common block nor a common window gathers its texts in a task.

Order by hash instead of by raw bytes keeps an entry at about 20 bytes; raw
100-byte keys would outgrow the disk several times.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.llm.common import U64, arrow_settings, byte_codes, drop_stage, mix, partitions, powers, stage, text_bytes

BLOCK = 32
SEGMENT = 1 << 19  # windows handled at once, also of one long text
BASE = 0x5851F42D4C957F2D
BASE_INV = pow(BASE, -1, 1 << 64)
HELD = 1 << 19  # entries a map task gathers before it sends them

ENTRY = np.dtype([("key", "<u4"), ("span", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("n", "<u4")])
RUN = np.dtype([("doc", "<i8"), ("start", "<u4"), ("n", "<u4")])
ANCHOR, REMOVED, UNSURE, LEVEL = 0, 1, 2, 3
# Entries on their way to a key part, and levels, are packed; repeats and
# unsure entries are plain rows, as many as there are runs whatever the parts.
ROWS = "kind int, part int, seq int, payload binary, doc long, start long, n long"
MAX_LEN = 512  # longer spans would outgrow the hash's 64 bits (see span_hash)
LEAST_BATCHES = 3  # the third batch meets two that were merged
BATCH_BYTES = 1 << 40


def pack(rows: np.ndarray) -> bytes:
    """Columns one after another, documents and counts narrowed: they compress."""
    low = int(rows["doc"].min()) if len(rows) else 0
    wide = len(rows) and int(rows["doc"].max()) - low > 0xFFFFFFFF
    many = rows.dtype == ENTRY and len(rows) and int(rows["n"].max()) > 255
    out = [np.array([len(rows), low, bool(wide) + 2 * bool(many)], "<i8").tobytes()]
    for name in rows.dtype.names:
        col = np.ascontiguousarray(rows[name])
        if name == "doc" and not wide:
            col = (col - low).astype("<u4")
        elif name == "n" and rows.dtype == ENTRY and not many:
            col = col.astype("u1")
        out.append(col.tobytes())
    return b"".join(out)


def unpack(payload: bytes, dtype: np.dtype) -> np.ndarray:
    n, low, flags = (int(x) for x in np.frombuffer(payload, "<i8", 3))
    wide, many = flags & 1, flags & 2
    rows, at = np.empty(n, dtype), 24
    for name in dtype.names:
        kind = dtype[name]
        if name == "doc" and not wide:
            kind = np.dtype("<u4")
        elif name == "n" and dtype == ENTRY and not many:
            kind = np.dtype("u1")
        col = np.frombuffer(payload, kind, n, at)
        at += n * kind.itemsize
        rows[name] = col.astype("<i8") + low if name == "doc" and not wide else col
    return rows


def gather(payloads, dtype: np.dtype) -> np.ndarray:
    parts = [unpack(p, dtype) for p in payloads]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which span_hash takes the hash of any stretch of ``data``."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(byte_codes(7)[data] * powers(BASE, len(data)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches. Modulo 2**64 regular texts of 1024 bytes or
    more can cancel out; spans of MAX_LEN windows stay below that."""
    back = powers(BASE_INV, len(sums))
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(U64))


def anchors(data: np.ndarray, min_len: int):
    """(start, n, key, span) of the suffix entries of one text segment."""
    n_win = len(data) - min_len + 1
    h = byte_codes(3)[data]
    step = 1
    mult = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
    for m in mult:
        h = h[:-step] * U64(m) + (h[step:] ^ (h[step:] >> U64(29)))
        step *= 2
    h = mix(h)
    low = (h & U64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U64)
    width, have = min_len - BLOCK + 1, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    at = (low[:n_win] & U64(0xFFFFFFFF)).astype(np.int64)
    return at, h


def segments(off: np.ndarray, min_len: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (row, first byte, end byte): short rows together, long rows cut
    so that each window lies in just one piece."""
    held, size = [], 0
    for row in np.flatnonzero(np.diff(off) >= min_len):
        a, b = int(off[row]), int(off[row + 1])
        for s in range(a, b - min_len + 1, SEGMENT):
            e = min(b, s + SEGMENT + min_len - 1)
            held.append((int(row), s, e))
            size += e - s
            if size >= SEGMENT:
                yield held
                held, size = [], 0
    if held:
        yield held


def entries(docs: np.ndarray, data: np.ndarray, off: np.ndarray, min_len: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffix entries (with the 64-bit key apart) of the rows, in pieces."""
    for group in segments(off, min_len):
        text = np.concatenate([data[s:e] for _, s, e in group]) if len(group) > 1 else data[group[0][1] : group[0][2]]
        ends = np.cumsum([e - s for _, s, e in group])
        begins = ends - np.array([e - s for _, s, e in group])
        at, h = anchors(text, min_len)
        # valid windows lie inside one piece
        valid = np.ones(len(at), bool)
        for e in ends[:-1]:
            valid[e - min_len + 1 : e] = False
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | ~valid[:-1]
        first = np.flatnonzero(new & valid)
        stop = np.flatnonzero(np.append(new[1:] | ~valid[1:], True) & valid) + 1
        sums = prefix_sums(text)
        piece = np.searchsorted(ends, first, "right")
        rows = np.empty(len(first), ENTRY)
        key = mix(h[at[first]])  # minima crowd at low values; spread them anew
        rows["span"] = span_hash(sums, first, stop - 1 + min_len)
        rows["n"] = stop - first
        row_of = np.array([r for r, _, _ in group])
        shift = np.array([s - off[r] for r, s, _ in group])
        rows["doc"] = docs[row_of[piece]]
        rows["start"] = first - begins[piece] + shift[piece]
        yield rows, key


def combine_map(rows: np.ndarray, key: np.ndarray):
    """Keep the earliest entry of each span; the others are repeats."""
    order = np.lexsort((rows["start"], rows["doc"], rows["span"]))
    rows, key = rows[order], key[order]
    first = np.ones(len(rows), bool)
    first[1:] = rows["span"][1:] != rows["span"][:-1]
    lead = np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))
    same = (rows["doc"] == rows["doc"][lead]) & (rows["start"] == rows["start"][lead])
    return rows[first], key[first], as_runs(rows[~first & ~same])


def as_runs(rows: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), RUN)
    for name in RUN.names:
        out[name] = rows[name]
    return merge_runs(out)


def merge_runs(rows: np.ndarray) -> np.ndarray:
    """Window runs of each document that touch or overlap become one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows["start"], rows["doc"]))]
    start, end = rows["start"].astype(np.int64), rows["start"].astype(np.int64) + rows["n"]
    new_doc = np.append(True, rows["doc"][1:] != rows["doc"][:-1])
    rank = np.cumsum(new_doc).astype(np.int64) << 34
    reach = np.maximum.accumulate(end + rank) - rank
    new = new_doc | np.append(True, start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    out = np.empty(len(first), RUN)
    out["doc"], out["start"] = rows["doc"][first], start[first]
    out["n"] = reach[np.append(first[1:], len(rows)) - 1] - start[first]
    return out


def split(rows: np.ndarray, part: np.ndarray, kind: int, seq: int) -> Iterator[tuple]:
    order = np.argsort(part, kind="stable")
    rows, part = rows[order], part[order]
    cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
    for a, b in zip(cuts[:-1], cuts[1:]):
        for s in range(a, b, 1 << 19):
            yield kind, int(part[s]), seq, pack(rows[s : min(b, s + (1 << 19))])


def packed_batch(rows: list[tuple]) -> pa.RecordBatch:
    kind, part, seq, payload = zip(*rows)
    none = pa.nulls(len(rows), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(part, pa.int32()), pa.array(seq, pa.int32()), pa.array(payload, pa.binary()), none, none, none], names=NAMES)


def sent(rows: Iterator[tuple], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size >= limit:
            yield packed_batch(held)
            held, size = [], 0
    if held:
        yield packed_batch(held)


def plain(rows: np.ndarray, kind: int, seq, parts: int = 0) -> Iterator[pa.RecordBatch]:
    """Runs or entries as plain rows; with ``parts`` they are dealt evenly."""
    for s in range(0, len(rows), 1 << 16):
        x = rows[s : s + (1 << 16)]
        part = (mix(x["doc"].astype(np.int64).view(U64)) % U64(parts)).astype(np.int32) if parts else np.zeros(len(x), np.int32)
        age = np.broadcast_to(seq, len(rows))[s : s + (1 << 16)].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), kind, np.int32)), pa.array(part), pa.array(age), pa.nulls(len(x), pa.binary()), *(pa.array(x[c].astype(np.int64)) for c in ("doc", "start", "n"))], names=NAMES)


NAMES = [x.split()[0] for x in ROWS.split(", ")]
SCHEMA = pa.schema(list(zip(NAMES, [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()])))


def passed(table: pa.Table) -> list[pa.RecordBatch]:
    """The plain repeats that came along with a part."""
    return table.filter(pc.equal(table.column("kind"), REMOVED)).select(NAMES).cast(SCHEMA).to_batches()


def suffix_entries(parts: int, seq: int, min_len: int):
    """mapInArrow: documents -> packed entries by key part, repeats as plain rows."""

    def flush(held):
        rows, key = (np.concatenate(x) for x in zip(*held))
        rows, key, runs = combine_map(rows, key)
        part = ((key >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
        rows["key"] = key & U64(0xFFFFFFFF)
        yield from sent(split(rows, part, ANCHOR, seq))
        yield from plain(runs, REMOVED, seq, parts)

    def run(batches):
        held, n = [], 0
        with np.errstate(over="ignore"):
            for batch in batches:
                docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
                data, off = text_bytes(batch.column("text"))
                for rows, key in entries(docs, data, off, min_len):
                    held.append((rows, key))
                    n += len(rows)
                    if n >= HELD:
                        yield from flush(held)
                        held, n = [], 0
            if held:
                yield from flush(held)

    return run


def merge_scan(seq: int, merged: tuple[int, ...], keep: bool):
    """applyInArrow over a key part: scan the batch against all levels.

    Rows with a smaller seq are levels. Gives repeats, unsure entries and,
    with ``keep``, the sorted suffix array of the batch and ``merged`` levels.
    """

    def run(table: pa.Table) -> pa.Table:
        out = passed(table)
        own = table.filter(pc.not_equal(table.column("kind"), REMOVED)).sort_by("seq")
        if own.num_rows:
            part = own.column("part")[0].as_py()
            loads = [unpack(p, ENTRY) for p in own.column("payload").to_pylist()]
            rows = np.concatenate(loads)
            age = np.repeat(own.column("seq").to_numpy(), [len(x) for x in loads])
            order = np.lexsort((rows["start"], rows["doc"], age, rows["span"], rows["key"]))
            rows, age = rows[order], age[order]
            new_key = np.append(True, rows["key"][1:] != rows["key"][:-1])
            new_span = new_key | np.append(True, rows["span"][1:] != rows["span"][:-1])
            lead = np.maximum.accumulate(np.where(new_span, np.arange(len(rows)), 0))
            same = (rows["doc"] == rows["doc"][lead]) & (rows["start"] == rows["start"][lead])
            out += plain(as_runs(rows[~new_span & ~same & (age == seq)]), REMOVED, seq)
            firsts, ages = rows[new_span], age[new_span]
            group = np.cumsum(new_key)[new_span] - 1
            unsure = (np.bincount(group)[group] > 1) & (np.bincount(group, ages == seq)[group] > 0)
            out += plain(firsts[unsure], UNSURE, ages[unsure])
            if keep:
                for a in (*merged, seq):
                    level = firsts[ages == a]
                    out += sent((LEVEL, part, int(a), pack(level[i : i + (1 << 19)])) for i in range(0, len(level), 1 << 19))
        return pa.Table.from_batches(out, SCHEMA)

    return run


class SuffixIndex:
    """A family of levels; level i holds the suffix arrays of 2**i batches."""

    def __init__(self, spark: SparkSession, min_len: int = 100, parts: int | None = None):
        self.spark, self.min_len = spark, min_len
        self.parts = parts or 2 * partitions(spark)
        if min_len > MAX_LEN:
            raise ValueError(f"min_len is at most {MAX_LEN}")
        self.levels: list[tuple[DataFrame, tuple[int, ...]] | None] = []
        self.seq = 0
        self.stages: list[DataFrame] = []

    def add(self, batch: DataFrame, keep: bool = True) -> DataFrame:
        """Scan a batch (doc_id, text) and merge it into the levels.

        Gives the repeats and unsure entries of the batch; ``keep`` false leaves the levels as they are (a last batch)."""
        docs = batch.filter("doc_id is not null and length(text) > 0").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        rows = docs.mapInArrow(suffix_entries(self.parts, self.seq, self.min_len), ROWS)
        carry = next((i for i, x in enumerate(self.levels) if x is None), len(self.levels))
        merged = tuple(s for x in self.levels[:carry] for s in x[1])
        for level in self.levels:
            if level:
                rows = rows.unionByName(level[0].withColumn("kind", F.lit(ANCHOR)))
        out = stage(rows.groupBy("part").applyInArrow(merge_scan(self.seq, merged, keep), ROWS), "suffix")
        self.stages.append(out)
        if keep:
            self.levels[:carry] = [None] * carry
            self.levels += [None] * (carry + 1 - len(self.levels))
            self.levels[carry] = (out.filter(F.col("kind") == LEVEL), (*merged, self.seq))
        self.seq += 1
        return out.filter(F.col("kind").isin(REMOVED, UNSURE))

    def drop(self) -> None:
        for x in self.stages:
            drop_stage(x)


def first_windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The earliest row of each window hash, and the runs of the others."""
    rows = rows[np.lexsort((rows["start"], rows["doc"], rows["age"], rows["code"]))]
    first = np.append(True, rows["code"][1:] != rows["code"][:-1]) if len(rows) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))
    same = (rows["doc"] == rows["doc"][lead]) & (rows["start"] == rows["start"][lead])
    later = rows[~first & ~same]
    runs = np.ones(len(later), RUN)
    runs["doc"], runs["start"] = later["doc"], later["start"]
    return rows[first], merge_runs(runs)


def windows_of(doc: int, data: np.ndarray, own: np.ndarray, min_len: int) -> np.ndarray:
    """The windows of the unsure entries ``own`` of one text."""
    n = own["n"].astype(np.int64)
    size = n + min_len - 1
    begin = np.cumsum(size) - size
    text = data[np.arange(size.sum()) + np.repeat(own["start"] - begin, size)]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pos = np.repeat(begin, n) + inner
    rows = np.empty(len(pos), WINDOW)
    rows["code"] = span_hash(prefix_sums(text), pos, pos + min_len)
    rows["doc"], rows["start"], rows["age"] = doc, np.repeat(own["start"], n) + inner, np.repeat(own["seq"], n)
    return rows


def unsure_windows(parts: int, min_len: int):
    """mapInArrow: documents with unsure entries -> the earliest of their
    windows by window hash, the repeats by document."""

    def flush(held):
        rows, runs = first_windows(np.concatenate(held))
        part = ((rows["code"] >> U64(32)) * U64(parts) >> U64(32)).astype(np.int64)
        yield from sent(split(rows, part, UNSURE, 0))
        yield from plain(runs, REMOVED, 0, parts)

    def run(batches):
        held, total = [], 0
        with np.errstate(over="ignore"):
            for batch in batches:
                data, off = text_bytes(batch.column("text"))
                docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
                for i, own in enumerate(lists(batch.column("loads"))):
                    own = np.rec.fromarrays([own & 0xFFF, own >> 32, (own >> 12) & 0xFFFFF], UNSURE_ROW)
                    own = own[np.argsort(own["start"], kind="stable")]
                    # an entry has few windows; a long text's entries are taken in pieces
                    piece = np.cumsum(own["n"], dtype=np.int64) // HELD
                    for some in np.split(own, np.flatnonzero(np.diff(piece)) + 1):
                        rows = windows_of(docs[i], data[off[i] : off[i + 1]], some, min_len)
                        held.append(rows)
                        total += len(rows)
                        if total >= HELD:
                            yield from flush(held)
                            held, total = [], 0
            if held:
                yield from flush(held)

    return run


WINDOW = np.dtype([("code", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("age", "<i4")])
UNSURE_ROW = np.dtype([("seq", "<i4"), ("start", "<u4"), ("n", "<u4")])


def lists(col: pa.Array) -> list[np.ndarray]:
    """The rows of an array<long> column."""
    off = col.offsets.to_numpy()
    flat = col.values.to_numpy()
    return [flat[a:b] for a, b in zip(off[:-1], off[1:])]


def window_scan(table: pa.Table) -> pa.Table:
    """applyInArrow over a part of the window hashes: windows that occur earlier."""
    out = passed(table)
    own = table.filter(pc.not_equal(table.column("kind"), REMOVED))
    _, runs = first_windows(gather(own.column("payload").to_pylist(), WINDOW))
    out += plain(runs, REMOVED, 0)
    return pa.Table.from_batches(out, SCHEMA)


def spans_by_doc(min_len: int):
    """mapInArrow: the runs of each document -> its removed byte spans."""

    def run(batches):
        for batch in batches:
            spans = []
            for own in lists(batch.column("runs")):
                rows = np.zeros(len(own), RUN)
                rows["start"], rows["n"] = own >> 32, (own & 0xFFFFFFFF) + min_len - 1
                rows = merge_runs(rows)
                start = rows["start"].astype("<i8")
                spans.append(np.stack([start, start + rows["n"]], 1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.binary())], names=["doc_id", "spans"])

    return run


def batches_for(docs: DataFrame) -> int:
    """Batches of about BATCH_BYTES, so many at least that levels merge."""
    total = docs.agg(F.sum(F.length(F.col("text").cast("binary")).cast("long"))).first()[0] or 0
    return max(LEAST_BATCHES, -(-total // BATCH_BYTES))


def repeated_spans(docs: DataFrame, min_len: int = 100, batches: int | None = None) -> DataFrame:
    """(doc_id, spans): the byte spans of each document covered by a string of
    ``min_len`` bytes that also starts earlier (smaller doc_id, or the same
    document further left); spans is an int64 array of (start, end) pairs.

    ``docs`` is fed to the index in ``batches`` ranges of doc_id, smallest
    first; by default as many as the bytes need and three at least, so that
    levels merge. ``min_len`` is from 32 to 512 bytes. Null or empty texts and null ids have no spans; rows repeated with
    the same doc_id and text count once.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    batches = batches or batches_for(docs)
    if batches > 1:
        cuts = docs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)
        cuts = sorted({int(x) for x in cuts})
    else:
        cuts = []
    edges = [None, *cuts, None]
    index = SuffixIndex(spark, min_len)
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        own = docs
        if a is not None:
            own = own.filter(F.col("doc_id") > a)
        if b is not None:
            own = own.filter(F.col("doc_id") <= b)
        index.add(own, keep=i < len(edges) - 2)
    found = index.stages[0]
    for x in index.stages[1:]:
        found = found.unionByName(x)
    code = lambda more: F.shiftleft("start", 32).bitwiseOR(more)
    loads = found.filter(F.col("kind") == UNSURE).groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(code(F.shiftleft("n", 12)).bitwiseOR(F.col("seq").cast("long"))).alias("loads"))
    texts = docs.filter("length(text) > 0").join(loads.hint("shuffle_hash"), "doc_id").mapInArrow(unsure_windows(index.parts, min_len), ROWS)
    partial = stage(texts.groupBy("part").applyInArrow(window_scan, ROWS), "windows")
    removed = found.filter(F.col("kind") == REMOVED).unionByName(partial)
    runs = removed.groupBy(F.col("doc").alias("doc_id")).agg(F.collect_list(code(F.col("n"))).alias("runs"))
    out = stage(runs.mapInArrow(spans_by_doc(min_len), "doc_id long, spans binary"), "spans")
    index.drop()
    drop_stage(partial)
    return out


def cut_spans(data: np.ndarray, spans: np.ndarray) -> bytes:
    """The bytes left once the (start, end) spans are removed."""
    at, out = 0, []
    for s, e in spans:
        out.append(data[at:s].tobytes())
        at = e
    out.append(data[at:].tobytes())
    return b"".join(out)


def kept_digest(batches):
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        n_removed, n_spans, sha = [], [], []
        for i, raw in enumerate(batch.column("spans").to_pylist()):
            spans = np.frombuffer(raw or b"", "<i8").reshape(-1, 2)
            left = cut_spans(data[off[i] : off[i + 1]], spans)
            n_removed.append(int((spans[:, 1] - spans[:, 0]).sum()))
            n_spans.append(len(spans))
            sha.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(off)), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha)],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def kept_texts(batches):
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        texts = batch.column("text").to_pylist()
        for i, raw in enumerate(batch.column("__spans").to_pylist()):
            if raw:
                left = cut_spans(data[off[i] : off[i + 1]], np.frombuffer(raw, "<i8").reshape(-1, 2))
                texts[i] = left.decode("utf-8", "ignore")
        cols = [pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in batch.schema.names if name != "__spans"]
        yield pa.RecordBatch.from_arrays(cols, names=[x for x in batch.schema.names if x != "__spans"])


def remove_repeats(docs: DataFrame, min_len: int = 100, batches: int | None = None) -> DataFrame:
    """``docs`` with the repeated spans cut out of ``text`` (a character cut in
    half goes too); all columns stay, a null text stays null. A plan over
    ``docs`` and the staged spans."""
    with arrow_settings(docs.sparkSession):
        spans = repeated_spans(docs, min_len, batches)
        joined = docs.join(spans.withColumnRenamed("doc_id", "__doc").withColumnRenamed("spans", "__spans").hint("shuffle_hash"), F.col("doc_id").cast("long") == F.col("__doc"), "left")
        return joined.drop("__doc").mapInArrow(kept_texts, docs.schema)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with arrow_settings(spark):
        spans = repeated_spans(docs)
        joined = docs.join(spans.hint("shuffle_hash"), "doc_id", "left")
        return stage(joined.mapInArrow(kept_digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "op1")
