"""Near-duplicate groups by HyperMinHash.

A document's shingle hashes fall into 256 buckets by their first bits; of each
bucket's smallest hash a register keeps the count of leading zeros and the ten
bits after them. Bands of eight registers, of six below 85 percent, are the
candidate keys (an empty register borrows the next one and its distance). Documents with equal shingle
sets form one class first. Pairs whose collision-corrected Jaccard estimate
lies far below the threshold go; the rest is confirmed on full shingle sets.
A sketch of the registers, two mantissa bits of each, travels with the band
keys of the second round and rules out most pairs before they are joined.

The first round pairs a band bucket's classes with its smallest and confirms
each class's best pair. The second takes the buckets that still hold several
components. Where at most four classes lie outside a bucket's largest
component, these centres meet the classes of other components in a join. The
classes of larger buckets are dealt into blocks, and each two blocks meet in a
cell that compares 4096 registers a class and gives out only the pairs that
these don't rule out, each in the first band it shares. So every candidate
pair of different components is judged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.llm.common import U64, arrow_settings, components, drop_stage, mix, shingle_sets, stage, text_bytes, word_hashes

BITS = 8  # 256 registers
MANTISSA = 10
BAND = 8  # a pair of similarity 0.85 shares none of the 32 bands with probability 4e-5, of 0.9 with 2e-8
NARROW = 6  # below 85 percent: a pair of similarity 0.8 shares none of the 42 bands with probability 3e-6
CENTRES = 4
FINE = 12  # 4096 registers where many classes share a bucket
BLOCK = 1024  # classes of a block in such a bucket; a class is copied once for each block of its bucket
MARGIN = 5.0  # standard deviations of the estimate below the threshold
EMPTY = np.uint16(0xFFFF)


def registers(hashes: np.ndarray, bits: int = BITS, mantissa: int = MANTISSA) -> np.ndarray:
    """Compressed registers of sorted hashes; EMPTY where a bucket has none."""
    m = 1 << bits
    edge = np.arange(m, dtype=U64) << U64(64 - bits)
    at = np.searchsorted(hashes, edge)
    full = at < np.append(at[1:], len(hashes))
    out = np.full(m, EMPTY, np.uint16)
    rest = hashes[at[full]] << U64(bits)
    # bit length by halving: exact for 64-bit values
    zeros = np.zeros(len(rest), np.int64)
    x = rest.copy()
    for step in (32, 16, 8, 4, 2, 1):
        low = x < (U64(1) << U64(64 - step))
        zeros[low] += step
        x[low] = x[low] << U64(step)
    zeros = np.minimum(zeros, 62)
    tail = (rest << (zeros + 1).astype(U64)) >> U64(64 - mantissa)
    out[full] = (zeros.astype(np.uint16) << np.uint16(mantissa)) | tail.astype(np.uint16)
    return out


def bands(reg: np.ndarray, width: int = BAND) -> np.ndarray:
    """64-bit keys of the bands of consecutive registers."""
    m = len(reg)
    full = np.flatnonzero(reg != EMPTY)
    near = np.searchsorted(full, np.arange(m))
    lead = full[near % len(full)]
    dist = (lead - np.arange(m)) % m
    value = reg[lead].astype(U64) | (dist.astype(U64) << U64(16))
    value = value[: m // width * width]  # registers that fill no band are left to the estimate
    key = np.arange(m // width, dtype=U64)
    for i in range(width):
        key = mix(key * U64(0x9E3779B97F4A7C15) + value[i::width])
    return key.view(np.int64)


def collisions(n: np.ndarray, m: np.ndarray, bits: int = BITS, mantissa: int = MANTISSA) -> np.ndarray:
    """Expected equal registers of two disjoint sets of sizes n and m: a
    register's smallest hashes agree by chance in zeros and mantissa."""
    big, small = np.maximum(n, m), np.minimum(n, m)
    share = 4.0 * (small / big) / (1 + small / big) ** 2
    return 0.169919487159739 * share * 2.0 ** (bits - mantissa)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corrected Jaccard estimates of register rows, and the registers in use."""
    used = (a != EMPTY) | (b != EMPTY)
    same = ((a == b) & used).sum(1)
    count = used.sum(1)
    return np.clip((same - collisions(n, m)) / np.maximum(count, 1), 0, 1), count


def sketch(reg: np.ndarray) -> np.ndarray:
    """Bit planes of the registers as 64-bit words: in use, and the two last
    mantissa bits."""
    full = reg != EMPTY
    planes = np.stack([full, full & (reg & 1 != 0), full & (reg & 2 != 0)])
    return np.packbits(planes, axis=1).view(np.int64).ravel()


def alike(s: str, t: str, percent: int, bits: int = BITS):
    """Whether the sketches in columns ``s`` and ``t`` don't rule out a link.

    A register in use on one side differs; one whose minima differ shows it in
    two bits three times of four. The estimated count of differing registers
    may lie MARGIN standard deviations over that of a pair at the threshold.
    """
    words = (1 << bits) // 64
    total = lambda term: " + ".join(f"bit_count({term(i)})" for i in range(words))
    used = total(lambda i: f"{s}[{i}] | {t}[{i}]")
    one = total(lambda i: f"{s}[{i}] ^ {t}[{i}]")
    both = total(lambda i: f"{s}[{i}] & {t}[{i}] & (({s}[{words + i}] ^ {t}[{words + i}]) | ({s}[{2 * words + i}] ^ {t}[{2 * words + i}]))")
    far = 1 - percent / 100
    spread = far * (1 - far) + far / 3
    return F.expr(f"({one}) + 4D / 3 * ({both}) <= {far!r}D * ({used}) + {MARGIN!r}D * sqrt({spread!r}D * ({used}))")


def fine_sketches(batches):
    """mapInArrow: (rep, text) -> (rep, fine), the sketch of 4096 registers."""
    with np.errstate(over="ignore"):
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            marks = [sketch(registers(s, FINE)).tobytes() for s in shingle_sets(data, off)]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(marks, pa.binary())], names=["rep", "fine"])


def cell(percent: int):
    """applyInArrow: two blocks of a bucket -> (a, b) not ruled out by their
    sketches, of different components, in the first band that they share."""
    far = 1 - percent / 100

    def run(table: pa.Table) -> pa.Table:
        rep, n, comp, block = (table.column(c).to_numpy() for c in ("rep", "n", "comp", "block"))
        key, lo, hi = (table.column(c)[0].as_py() for c in ("key", "lo", "hi"))
        keys = np.array(table.column("bands").to_pylist(), np.int64)
        fine = np.frombuffer(b"".join(table.column("fine").to_pylist()), U64).reshape(len(rep), 3, -1)
        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        a, b = [], []
        for i in left:
            j = right[right > i] if lo == hi else right
            j = j[(comp[j] != comp[i]) & (np.minimum(n[j], n[i]) * 100 >= percent * np.maximum(n[j], n[i]))]
            shared = keys[j] == keys[i]
            j = j[keys[i][shared.argmax(1)] == key]
            x, y = fine[i], fine[j]
            used = np.bitwise_count(y[:, 0] | x[0]).sum(1, dtype=np.int64)
            one = np.bitwise_count(y[:, 0] ^ x[0]).sum(1, dtype=np.int64)
            both = np.bitwise_count(y[:, 0] & x[0] & ((y[:, 1] ^ x[1]) | (y[:, 2] ^ x[2]))).sum(1, dtype=np.int64)
            # registers sample the pair's shingles without replacement: few shingles, little spread
            unseen = np.maximum(1 - used * (1 + percent / 100) / (n[i] + n[j]), 0)
            over = 300 * one + 400 * both - 3 * (100 - percent) * used  # in integers: a pair at the threshold may leave no spread
            j = j[over <= 300 * MARGIN * np.sqrt(far * (1 - far) * used * unseen + 4 / 9 * both)]
            a.append(np.minimum(rep[i], rep[j]))
            b.append(np.maximum(rep[i], rep[j]))
        whole = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
        return pa.table({"a": whole(a), "b": whole(b)})

    return run


def signatures(batches):
    """mapInArrow: documents -> SIGNATURE."""
    with np.errstate(over="ignore"):
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            n, ident, regs = [], [], []
            for s in shingle_sets(data, off):
                n.append(len(s))
                ident.append(np.array([mix(s).sum(), mix(s ^ U64(0xD1B54A32D192ED03)).sum(), len(s)], U64).tobytes() if len(s) else None)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ident, pa.binary()), pa.array(regs, pa.binary())], names=["doc_id", "n_shingles", "ident", "regs"])


SIGNATURE = "doc_id long, n_shingles long, ident binary, regs binary"


def band_keys(width: int):
    """mapInArrow: (rep, n, regs) -> (rep, n, key), a row for each band."""

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                keys = [bands(np.frombuffer(x, np.uint16), width) for x in batch.column("regs").to_pylist()]
                if keys:
                    at = pa.array(np.repeat(np.arange(len(keys)), len(keys[0])))
                    yield pa.RecordBatch.from_arrays([batch.column("rep").take(at), batch.column("n").take(at), pa.array(np.concatenate(keys))], names=["rep", "n", "key"])

    return run


def band_lists(width: int):
    """mapInArrow: (rep, regs) -> (rep, bands)."""

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                keys = [bands(np.frombuffer(x, np.uint16), width).tolist() for x in batch.column("regs").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(keys, pa.list_(pa.int64()))], names=["rep", "bands"])

    return run


def sketches(batches):
    """mapInArrow: (rep, regs) -> (rep, sketch)."""
    for batch in batches:
        marks = [sketch(np.frombuffer(x, np.uint16)).tolist() for x in batch.column("regs").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(marks, pa.list_(pa.int64()))], names=["rep", "sketch"])


def likely(percent: int):
    """mapInArrow: pairs with registers -> (a, b, est) not far below the threshold."""

    def run(batches):
        t = percent / 100
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for c in ("ra", "rb"))
            n, m = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            est, count = estimate(a, b, n, m)
            # sizes alone bound the similarity; few registers say little
            ok = (np.minimum(n, m) * 100 >= percent * np.maximum(n, m)) & (est >= t - MARGIN * np.sqrt(t * (1 - t) / np.maximum(count, 1)))
            pick = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pick), batch.column("b").filter(pick), pa.array(est[ok])], names=["a", "b", "est"])

    return run


def exact_sets(texts: list[pa.Array], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle) of the distinct shingles of some texts' columns, text by
    text; shingles are numbered by their words, not by a hash of them."""
    column = pa.concat_arrays([x.cast(pa.large_string()) for x in texts])
    data, off = text_bytes(column)
    _, row, start, end = word_hashes(data, off)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    size = end - start
    bounds = np.append(0, np.cumsum(size)).astype(np.int64)
    inner = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], size)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(low[inner])])
    word = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    count = np.bincount(row, minlength=len(column))
    last = np.repeat(np.cumsum(count), count)  # end of each word's text
    width = np.minimum(k, np.repeat(count, count))  # fewer words: the whole sequence
    head = np.flatnonzero(np.arange(len(word)) + width <= last)
    # one word more at a time; a missing one is number 0, so lengths differ too
    code = word[head] + 1
    for i in range(1, k):
        more = np.where(i < width[head], word[np.minimum(head + i, len(word) - 1)] + 1, 0)
        code = np.unique(code * (len(word) + 1) + more, return_inverse=True)[1].astype(np.int64)
    pair = np.unique(row[head].astype(np.int64) * (len(word) + 1) + code)
    return np.divmod(pair, len(word) + 1)


def confirmed(percent: int):
    """mapInArrow: pairs with texts -> the pairs whose shingle sets are similar."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            text, shingle = exact_sets([batch.column("ta"), batch.column("tb")])
            size = np.bincount(text, minlength=2 * n)
            left = (text % max(n, 1)) * (shingle.max(initial=0) + 1) + shingle
            _, times = np.unique(left, return_counts=True)
            both = np.bincount((np.unique(left)[times == 2] // (shingle.max(initial=0) + 1)), minlength=n)
            keep = pa.array(100 * both >= percent * (size[:n] + size[n:] - both), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    return run


HUB = 1024  # pairs of one document that go into one join key


def with_both(pairs: DataFrame, rows: DataFrame, names: list[str]) -> DataFrame:
    """Pairs with the columns ``names`` of their documents: x of ``rows`` is xa
    and xb. A document with many pairs as ``a`` is copied to several join keys,
    HUB pairs each, so no task holds all pairs of a hub."""
    side = lambda x: rows.select(F.col("rep").alias(x), *(F.col(n).alias(f"{n}{x}") for n in names))
    hubs = pairs.groupBy(F.col("a").alias("hub")).agg(F.count(F.lit(1)).alias("of")).filter(F.col("of") > HUB).select("hub", F.ceil(F.col("of") / HUB).alias("keys"))
    dealt = pairs.join(hubs, F.col("a") == F.col("hub"), "left").drop("hub")
    few = dealt.filter("keys is null").drop("keys").join(side("b"), "b").join(side("a"), "a")
    many = dealt.filter("keys is not null").withColumn("salt", F.pmod(F.xxhash64("b"), "keys")).drop("keys").join(side("b"), "b")
    copies = side("a").join(hubs, F.col("a") == F.col("hub")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("keys") - 1))).drop("hub", "keys")
    return few.unionByName(many.join(copies, ["a", "salt"]).drop("salt"))


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    both = with_both(pairs, texts.select("rep", F.col("text").alias("t")), ["t"])
    return both.select("a", "b", "ta", "tb").mapInArrow(confirmed(percent), "a long, b long")


def promising(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, est) of the pairs whose registers don't rule out a link."""
    both = with_both(pairs.select("a", "b"), classes.select("rep", "n", F.col("regs").alias("r")), ["n", "r"]).select("a", "b", "na", "nb", "ra", "rb")
    return both.mapInArrow(likely(percent), "a long, b long, est double")


def involved_texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    reps = pairs.select(F.col("a").alias("rep")).distinct().unionAll(pairs.select(F.col("b").alias("rep")).distinct()).distinct()
    return stage(docs.join(reps.hint("shuffle_hash"), F.col("doc_id") == F.col("rep")).select("rep", "text").dropDuplicates(["rep"]), "texts")


def crowded_pairs(crowded: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """(a, b): candidate pairs of different components in the buckets of
    ``crowded`` (key, rep, n, comp, total), ``total`` being the bucket's classes.

    Every two blocks of a bucket are a cell of their own, so a bucket of any
    size is spread over the cluster and a cell holds about 2 * BLOCK classes.
    """
    reps = crowded.select("rep").distinct()
    texts = docs.join(reps.hint("shuffle_hash"), F.col("doc_id") == F.col("rep")).select("rep", "text").dropDuplicates(["rep"])
    fine = texts.mapInArrow(fine_sketches, "rep long, fine binary")
    keys = classes.select("rep", "regs").mapInArrow(band_lists(width), "rep long, bands array<long>")
    known = stage(fine.join(keys, "rep"), "fine")
    blocks = crowded.withColumn("nb", F.ceil(F.col("total") / BLOCK).cast("int"))
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
    cells = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    cells = cells.select("key", "rep", "n", "comp", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"))
    return cells.join(known, "rep").groupBy("key", "lo", "hi").applyInArrow(cell(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Linked: 100 * common shingles >= percent * all shingles of the pair.
    A document without words has no shingles and is its own component. Rows of
    one doc_id count as one document. A null doc_id takes no part: its
    component is null and it is kept. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    width = BAND if percent >= 85 else NARROW
    sig = stage(docs.mapInArrow(signatures, SIGNATURE), "signatures")
    known = sig.filter("ident is not null and doc_id is not null")
    classes = stage(known.groupBy("ident").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs")), "classes")
    # registers stay with the classes alone
    idents = stage(sig.select("doc_id", "n_shingles", "ident"), "idents")
    drop_stage(sig)
    near = lambda x, y: 100 * F.least(x, y) >= percent * F.greatest(x, y)  # noqa: E731  sizes bound the similarity
    keys = classes.select("rep", "n", "regs").mapInArrow(band_keys(width), "rep long, n long, key long")
    shared = keys.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("lo"), F.max("rep").alias("hi")).filter("lo.rep < hi")
    shared = shared.select("key", F.col("lo.rep").alias("lo"), F.col("lo.n").alias("lo_n"))
    members = stage(keys.join(shared, "key"), "members")

    # first round: a bucket's smallest document against the others
    first = members.filter((F.col("rep") != F.col("lo")) & near("n", "lo_n")).select(F.col("lo").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = stage(promising(first, classes, percent), "pairs")
    texts = involved_texts(docs, pairs)
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("est", -F.col("a"))).alias("a")).select("a", "b")
    links = stage(confirm(best, texts, percent), "links")
    comp = stage(components(links), "comp")

    # second round: buckets that still hold several components
    now = classes.select("rep", "regs").mapInArrow(sketches, "rep long, sketch array<long>").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    named = members.select("key", "rep", "n").join(now, "rep").withColumn("comp", F.coalesce("component", "rep"))
    named = stage(named.select("key", "rep", "n", "comp", "sketch"), "named")
    sizes = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("alike"))
    # the largest component of a bucket, and how many classes lie outside it
    sizes = sizes.groupBy("key").agg(F.sum("alike").alias("total"), F.max(F.struct("alike", "comp")).alias("top"), F.count(F.lit(1)).alias("kinds"))
    sizes = sizes.filter("kinds > 1").select("key", "total", F.col("top.comp").alias("main"), (F.col("total") - F.col("top.alike")).alias("outside"))
    mixed = stage(named.join(sizes, "key"), "mixed")
    few = mixed.filter(F.col("outside") <= CENTRES)
    centres = few.filter("comp != main").select("key", F.col("rep").alias("c"), F.col("n").alias("cn"), F.col("comp").alias("cc"), F.col("sketch").alias("csketch"))
    second = few.join(centres, "key").filter((F.col("comp") != F.col("cc")) & near("n", "cn") & alike("sketch", "csketch", percent)).select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")).distinct()
    more_pairs = promising(second.join(best, ["a", "b"], "left_anti"), classes, percent).select("a", "b")
    crowded = mixed.filter(F.col("outside") > CENTRES).select("key", "rep", "n", "comp", "total")
    if crowded.limit(1).count():
        more_pairs = more_pairs.unionByName(crowded_pairs(crowded, classes, docs, percent, width)).distinct()
    more_pairs = stage(more_pairs, "pairs")
    more_texts = involved_texts(docs, more_pairs)
    more = stage(confirm(more_pairs, more_texts, percent), "links")
    if more.limit(1).count():
        drop_stage(comp)
        comp = stage(components(links.unionByName(more)), "comp")
    for x in (members, named, mixed, pairs, texts, more_pairs, more_texts, links, more):
        drop_stage(x)

    whole = classes.select("ident", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    whole = whole.select("ident", F.coalesce("component", "rep").alias("whole"))
    out = idents.join(whole, "ident", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("whole", "doc_id")).alias("component_id")
    out = stage(out.select("doc_id", "n_shingles", component).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "groups")
    for x in (idents, classes, comp):
        drop_stage(x)
    return out


def keep_one(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` without the documents whose component has a smaller doc_id; a
    plan over ``docs`` and the staged groups, all columns stay."""
    with arrow_settings(docs.sparkSession):
        gone = near_duplicates(docs, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
        return docs.join(gone.hint("shuffle_hash"), F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")


def op7_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    with arrow_settings(spark):
        return near_duplicates(docs)
