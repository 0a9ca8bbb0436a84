"""Phrase collocations by Toivonen's sampling method.

A hashed sample of the documents proposes the words and word pairs that may be
frequent (two level-wise counts over the sample, at a lowered support). One
pass over all documents then counts, exactly, the proposals and their negative
border: every word, every pair of proposed words and every triple of proposed
pairs. Whatever of the border turns out frequent is a border failure; it joins
the proposals, and a further pass counts just the phrases this lets in, until
no failure is left. So the counts are exact whatever the sample held.

Proposals reach the tasks as a Bloom filter of a fixed size. A false positive
only has some further phrases counted; phrases are compared by their text.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickcast.llm.common import U64, arrow_settings, byte_codes, drop_stage, mix, powers, stage, text_bytes

MIN_COUNT = 10
SAMPLE_SHARE = 16  # one document of so many is in the sample
SAMPLE_SUPPORT = 3  # count in the sample from which a phrase is proposed
FILTER_BITS = 24  # 2 MB; fuller filters let more phrases be counted, counts stay exact
PER_LANG = 2000
SALTS = 32
CHUNK = 3 << 20  # words counted at once in a task
PART_ROWS = 128  # texts cut into words at once
SENT_ROWS = 1 << 16

BLANK = pa.scalar(" ", pa.large_string())

END = pa.scalar("\n", pa.large_string())  # in no phrase

#: A phrase and its language in one column; a line end parts them. The empty
#: phrase stands for all words of a language.
COUNTS = "gram string, c long"


def byte_classes() -> np.ndarray:
    """0 for bytes of words, 1 for blanks between words, 2 for ends of pieces."""
    out = np.zeros(256, np.uint8)
    out[[0x20, 0x09]] = 1
    out[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
    return out


@dataclass
class Words:
    """The words of some texts in order."""

    names: pa.Array  # distinct words
    code: np.ndarray  # of each word its place in ``names``
    row: np.ndarray
    follows: np.ndarray  # whether the word before lies in the same piece


def words_of(data: np.ndarray, off: np.ndarray) -> Words:
    data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    kind = byte_classes()[data]
    inside = kind == 0
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = off[:-1][np.diff(off) > 0]
    begin[heads] = inside[heads]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    tails = off[1:][np.diff(off) > 0] - 1
    stop[tails] = inside[tails]
    start = np.flatnonzero(begin)
    bounds = np.append(0, np.cumsum(np.flatnonzero(stop) + 1 - start)).astype(np.int64)
    row = np.searchsorted(off, start, "right") - 1
    breaks = np.searchsorted(np.flatnonzero(kind == 2), start)
    follows = np.zeros(len(start), bool)
    follows[1:] = (row[1:] == row[:-1]) & (breaks[1:] == breaks[:-1])
    text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])])
    named = text.dictionary_encode()
    return Words(named.dictionary, named.indices.to_numpy(zero_copy_only=False), row, follows)


def joined(parts: list[Words]) -> Words:
    """The words of several texts' parts under one dictionary; rows number on."""
    coded = pa.chunked_array([pa.DictionaryArray.from_arrays(pa.array(w.code), w.names) for w in parts]).unify_dictionaries()
    return Words(
        coded.chunk(0).dictionary,
        np.concatenate([x.indices.to_numpy(zero_copy_only=False) for x in coded.chunks]),
        np.concatenate([w.row for w in parts]),
        np.concatenate([w.follows for w in parts]),
    )


def name_hashes(names: pa.Array) -> np.ndarray:
    data, off = text_bytes(names)
    size = np.diff(off)
    if not len(size):
        return np.zeros(0, U64)
    inner = np.arange(len(data)) - np.repeat(off[:-1], size)
    return mix(np.add.reduceat(byte_codes(17)[data] * powers(0x9E3779B97F4A7C15, int(size.max()))[inner], off[:-1]) + size.astype(U64))


def lang_hash(lang: str) -> U64:
    return U64(zlib.crc32(lang.encode()) * 0x9E3779B1 + 1)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U64(0xC2B2AE3D27D4EB4F) + mix(b + U64(1)))


class Filter:
    """A Bloom filter of phrase hashes; each hash sets two bits."""

    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(1 << (bits - 6), U64) if words is None else words

    def places(self, h: np.ndarray) -> np.ndarray:
        return np.concatenate([h >> U64(64 - self.bits), mix(h + U64(7)) >> U64(64 - self.bits)])

    def has(self, h: np.ndarray) -> np.ndarray:
        at = self.places(h)
        hit = (self.words[at >> U64(6)] >> (at & U64(63))) & U64(1) == 1
        return hit[: len(h)] & hit[len(h) :]


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each key among the distinct ones, the distinct keys)."""
    named = pa.array(key).dictionary_encode()
    return named.indices.to_numpy(zero_copy_only=False).astype(np.int64), named.dictionary.to_numpy(zero_copy_only=False)


def count_chunk(w: Words, langs: list[pa.Array], level: int, now: Filter | None, before: Filter | None):
    """(gram, c) columns of a chunk.

    Level 1 counts words, level 2 pairs of words in ``now``, level 3 all of
    the border: words, pairs of words in ``now``, triples of pairs in ``now``.
    With ``before`` only what that filter did not let in is counted.
    """
    lang = pa.concat_arrays([x.cast(pa.string()) for x in langs]).dictionary_encode()
    lang_names, lang_code = lang.dictionary, lang.indices.to_numpy(zero_copy_only=False)
    if not len(w.code):
        return
    v = len(w.names)
    word, pairs_of = distinct(lang_code[w.row].astype(np.int64) * v + w.code)
    of_lang, of_name = np.divmod(pairs_of, v)
    names, wide = w.names.cast(pa.large_string()), lang_names.cast(pa.large_string())

    def column_of(place: np.ndarray) -> pa.Array:
        return names.take(pa.array(of_name[place]))

    def out(first: np.ndarray, phrase: pa.Array, c: np.ndarray):
        return pc.binary_join_element_wise(phrase, wide.take(pa.array(of_lang[first])), END), c

    count = np.bincount(word, minlength=len(pairs_of))
    if before is None and level != 2:
        every = np.arange(len(pairs_of))
        yield out(every, column_of(every), count)
        per = np.bincount(of_lang, count, len(lang_names)).astype(np.int64)
        yield pc.binary_join_element_wise(pa.scalar("", pa.large_string()), wide, END), per
    if level == 1:
        return
    hashed = mix(name_hashes(w.names)[of_name] ^ np.array([lang_hash(x) for x in lang_names.to_pylist()], U64)[of_lang])
    fresh = now.has(hashed)
    old = before.has(hashed) if before else np.zeros(len(hashed), bool)
    at = np.flatnonzero(w.follows[1:] & fresh[word[:-1]] & fresh[word[1:]])
    if not len(at):
        return
    n = len(pairs_of)
    pair, pair_key = distinct(word[at] * n + word[at + 1])
    one, two = np.divmod(pair_key, n)
    new = np.flatnonzero(~(old[one] & old[two]))
    c = np.bincount(pair, minlength=len(pair_key))
    if len(new):
        yield out(one[new], pc.binary_join_element_wise(column_of(one[new]), column_of(two[new]), BLANK), c[new])
    if level == 2:
        return
    h = pair_hash(hashed[one], hashed[two])
    fresh = now.has(h)
    old = before.has(h) & old[one] & old[two] if before else np.zeros(len(h), bool)
    # a pair at ``at`` and one at the word after it make a triple
    chain = np.flatnonzero((np.diff(at) == 1) & fresh[pair[:-1]] & fresh[pair[1:]] & ~(old[pair[:-1]] & old[pair[1:]]))
    if len(chain):
        triple, key = distinct(pair[chain] * n + two[pair[chain + 1]])
        head, last = np.divmod(key, n)
        phrase = pc.binary_join_element_wise(column_of(one[head]), column_of(two[head]), column_of(last), BLANK)
        yield out(one[head], phrase, np.bincount(triple, minlength=len(key)))


def gram_counts(level: int, now, before):
    """mapInArrow: (lang, text) -> COUNTS, summed within chunks of text."""

    def sent(words, langs):
        with np.errstate(over="ignore"):
            for gram, c in count_chunk(joined(words), langs, level, now and now.value, before and before.value):
                for s in range(0, len(c), SENT_ROWS):
                    part = slice(s, s + SENT_ROWS)
                    yield pa.RecordBatch.from_arrays([gram[part].cast(pa.string()), pa.array(c[part].astype(np.int64))], names=["gram", "c"])

    def run(batches):
        words, langs, held, rows = [], [], 0, 0
        for batch in batches:
            for s in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(s, PART_ROWS)
                w = words_of(*text_bytes(part.column("text")))
                w.row += rows
                rows += part.num_rows
                words.append(w)
                langs.append(part.column("lang"))
                held += len(w.code)
                if held >= CHUNK:
                    yield from sent(words, langs)
                    words, langs, held, rows = [], [], 0, 0
        if words:
            yield from sent(words, langs)

    return run


def phrase_hashes(lang: list[str], phrases: pa.Array) -> np.ndarray:
    """Hashes of phrases of one or two words, as count_chunk has them."""
    w = words_of(*text_bytes(phrases))
    h = mix(name_hashes(w.names)[w.code] ^ np.array([lang_hash(x) for x in lang], U64)[w.row])
    first = np.flatnonzero(~w.follows)
    out = h[first]
    second = np.flatnonzero(w.follows)
    out[w.row[second]] = pair_hash(h[second - 1], h[second])
    return out


def set_bits(bits: int):
    """mapInArrow: (lang, phrase) -> the filter words they set, joined in a batch."""

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                if batch.num_rows:
                    at = Filter(bits).places(phrase_hashes(batch.column("lang").to_pylist(), batch.column("phrase")))
                    word, place = np.unique(at >> U64(6), return_inverse=True)
                    got = np.zeros(len(word), U64)
                    np.bitwise_or.at(got, place, U64(1) << (at & U64(63)))
                    yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int32)), pa.array(got.view(np.int64))], names=["word", "bits"])

    return run


def unknown(known):
    """mapInArrow: the phrases that the filter does not hold (border failures)."""

    def run(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                if batch.num_rows:
                    has = known.value.has(phrase_hashes(batch.column("lang").to_pylist(), batch.column("phrase")))
                    yield batch.filter(pa.array(~has))

    return run


def with_phrases(phrases: DataFrame, known: Filter) -> Filter:
    """``known`` with further phrases; at most 2**(bits - 6) rows are collected."""
    rows = phrases.select("lang", "phrase").mapInArrow(set_bits(known.bits), "word int, bits long")
    got = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = known.words.copy()
    words[got.column("word").to_numpy()] |= got.column("bits").to_numpy().view(U64)
    return Filter(known.bits, words)


def named(grams: DataFrame) -> DataFrame:
    """(lang, phrase, len, c); words of a language have len 0."""
    phrase = F.substring_index("gram", "\n", 1)
    size = F.when(phrase == "", 0).otherwise(F.size(F.split(phrase, " ")))
    return grams.select(F.expr("substr(gram, instr(gram, '\n') + 1)").alias("lang"), phrase.alias("phrase"), size.alias("len"), "c")


def frequent_phrases(docs: DataFrame, min_count: int, share: int, support: int, bits: int) -> DataFrame:
    """(lang, phrase, len, c) of all phrases of one to three words that occur
    ``min_count`` times or more in a language, and rows of len 0: the words of
    a language (of ``min_count`` words or more; others have no phrases)."""
    spark = docs.sparkSession
    cast = spark.sparkContext.broadcast
    texts = docs.filter("length(text) > 0").select(F.coalesce("lang", F.lit("und")).alias("lang"), "text", F.xxhash64("doc_id", "text").alias("_h"))
    sample = texts.filter(F.pmod("_h", F.lit(share)) == 0).select("lang", "text")
    texts = texts.select("lang", "text")

    def counted(rows: DataFrame, level: int, now=None, before=None) -> DataFrame:
        # chunks are summed already: the rows are dealt first, so that they are hashed once
        got = rows.mapInArrow(gram_counts(level, now, before), COUNTS).repartition("gram")
        return named(got.groupBy("gram").agg(F.sum("c").alias("c")).filter(F.col("c") >= (min_count if level == 3 else support)))

    # proposals, level by level
    known = with_phrases(counted(sample, 1).filter("len = 1"), Filter(bits))
    known = with_phrases(counted(sample, 2, cast(known)), known)

    # proposals and border, then what border failures let in, until closed
    found, before = [], None
    while True:
        now = cast(known)
        found.append(stage(counted(texts, 3, now, before), "phrases"))
        failed = stage(found[-1].filter(F.col("len").isin(1, 2)).mapInArrow(unknown(now), "lang string, phrase string, len int, c long"), "border")
        if not failed.limit(1).count():
            break
        known, before = with_phrases(failed, known), now
        drop_stage(failed)
    drop_stage(failed)
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    # every phrase is counted by one pass only: the first whose filter holds its parts
    out = stage(out, "frequent")
    for x in found:
        drop_stage(x)
    return out


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, per_lang: int = PER_LANG, share: int = SAMPLE_SHARE, support: int = SAMPLE_SUPPORT, bits: int = FILTER_BITS
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    ``docs`` has doc_id, text and lang; other columns are not read. Texts that
    are null, empty or without words have no phrases, a null lang is ``und``.
    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at blanks
    and tabs. Repeated rows count each time. Candidates are phrases of two or
    three words that occur ``min_count`` times or more; a pair is dropped if a
    triple around it has half of its count or more. The score of a cut is
    floor(1000000 * a * a / (l * r)), computed in decimals; the lowest cut
    counts, equal ones the leftmost. Ties rank by count, then by the phrase's
    bytes. An empty table gives no rows.
    """
    spark = docs.sparkSession
    with arrow_settings(spark):
        counts = frequent_phrases(docs, min_count, share, support, bits)
        parts = F.split("phrase", " ")
        own = counts.filter("len > 1").withColumn("w", parts)
        both = lambda i, j: F.array_join(F.slice("w", i, j), " ")
        cut = lambda k: F.struct(F.lit(k).alias("k"), both(1, k).alias("left"), F.expr(f"array_join(slice(w, {k + 1}, 2), ' ')").alias("right"))
        cuts = own.select("lang", "phrase", F.col("c").alias("a"), F.col("len"), F.explode(F.when(F.col("len") == 2, F.array(cut(1))).otherwise(F.array(cut(1), cut(2)))).alias("cut")).select("lang", "phrase", "a", "len", "cut.*")
        parts_of = counts.filter("len in (1, 2)")
        cuts = cuts.join(parts_of.select("lang", F.col("phrase").alias("left"), F.col("c").alias("l")), ["lang", "left"])
        cuts = cuts.join(parts_of.select("lang", F.col("phrase").alias("right"), F.col("c").alias("r")), ["lang", "right"])
        score = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
        scored = cuts.withColumn("score", score.cast("long"))
        scored = scored.groupBy("lang", "phrase", "len", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        inner = own.filter("len = 3").select("lang", F.explode(F.array(both(1, 2), F.array_join(F.slice("w", 2, 2), " "))).alias("phrase"), "c")
        inner = inner.groupBy("lang", "phrase").agg(F.max("c").alias("longer"))
        left = scored.join(inner, ["lang", "phrase"], "left").filter("len = 3 or longer is null or 100 * longer < 50 * a")
        left = left.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
        order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
        salted = left.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        some = salted.withColumn("rank", F.row_number().over(W.partitionBy("lang", "_s").orderBy(*order))).filter(F.col("rank") <= per_lang)
        top = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= per_lang)
        words = counts.filter("len = 0").select("lang", F.col("c").alias("n"))
        out = stage(top.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
        drop_stage(counts)
        return out


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, unnest(w) AS phrase, 1 AS len FROM words
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])), 2 FROM words
  UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])), 3 FROM words
), f AS (
  SELECT lang, phrase, len, count(*) AS c FROM grams GROUP BY ALL
), n AS (
  SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE len = 1 GROUP BY lang
), cand AS (
  SELECT lang, phrase, len, c AS a, string_split(phrase, ' ') AS w FROM f WHERE len > 1 AND c >= 10
), cuts AS (
  SELECT lang, phrase, len, a, w, k, array_to_string(w[:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM cand, (VALUES (1), (2)) t(k) WHERE k < len
), scored AS (
  SELECT u.lang, u.phrase, u.len, u.a, u.k, x.c AS l, y.c AS r,
         CAST((1000000::HUGEINT * u.a * u.a) // (x.c::HUGEINT * y.c) AS BIGINT) AS score
  FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = u.lp AND x.len = u.k
              JOIN f y ON y.lang = u.lang AND y.phrase = u.rp AND y.len = u.len - u.k
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE len = 3
    UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE len = 3) GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
       b.phrase, a, l, r, n.n, score
FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase JOIN n ON n.lang = b.lang
WHERE b.len = 3 OR longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""
