"""Quality rules by distribution divergence, in DataFrame operations only.

A document's character-class and common-word histograms are compared with its
language's reference by the Jensen-Shannon distance (base 2). A reference is
the mean histogram of the language's documents that pass the base rules and
the length guards; a language with few such documents takes the mean of all.
A distance counts only if the document is long enough for a steady histogram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.llm.common import arrow_settings, drop_stage, stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CHARS = 300  # for the character-class distance
MIN_COMMON_WORDS = 100  # for the common-word distance
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.24  # plus WORD_NOISE / sqrt(words): short histograms scatter
WORD_NOISE = 0.9
MIN_REFERENCE = 30  # documents behind a language's own reference
LANGS = 64  # languages whose references are broadcast, the most frequent: no other has a large share of the rows

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
LOWER = "abcdefghijklmnopqrstuvwxyz"
OTHER_MARKS = "!\"'()+,-./:;=?@[\\]^_`{}~"

# Frequent function words of English, German, French and Spanish.
COMMON = """
the of and to in a is that it was for on with as be are this by not or
der die das und ist nicht ein eine mit von den zu auf für im dem sich des
le la les des un une et est pour dans que qui sur par au du pas plus
el los las de una y en por con para es se del al lo como su
""".split()
COMMON = list(dict.fromkeys(COMMON))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")


def counted(docs: DataFrame) -> DataFrame:
    """The base columns and both histograms (arrays of counts) of each document."""
    df = docs.withColumn("t", F.coalesce("text", F.lit(""))).drop("text")
    # each class is what its removal shortens; the rest grows shorter every time
    left, names = "t", []
    for name, chars in (("lower", LOWER), ("upper", LOWER.upper()), ("blank", BLANKS), ("digit", "0123456789"), ("symbol", SYMBOLS), ("mark", OTHER_MARKS)):
        df = df.withColumn(f"_{name}", F.translate(left, chars, ""))
        df = df.withColumn(f"c_{name}", F.char_length(left) - F.char_length(f"_{name}"))
        left = f"_{name}"
        names.append(f"c_{name}")
    df = df.withColumn("c_other", F.char_length(left))
    names.append("c_other")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    df = df.withColumn("lines", lines).withColumn("w", words_of(F.col("t")))
    df = df.withColumn("common", F.filter(F.transform("w", lambda x: F.lower(x)), lambda x: x.isin(COMMON)))
    vocab = F.array(*[F.lit(x) for x in COMMON])
    hits = F.transform(vocab, lambda v: F.size("common") - F.size(F.array_remove("common", v)))
    df = df.withColumn("hits", hits)
    return df.select(
        "doc_id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        (F.char_length("t") - F.col("c_blank")).cast("long").alias("word_chars"),
        F.col("c_symbol").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.array(*[F.col(x).cast("double") for x in names if x != "c_blank"]).alias("classes"),
        F.concat(F.col("hits"), F.array(F.size("w") - F.size("common"))).cast("array<double>").alias("frequent"),
        "w",
    )


def repeated_words(df: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in 3-word windows found twice or more.

    Windows are sorted as (32-bit hash, position) longs; those whose hash has
    an equal neighbour are sorted again as texts, which decides. Positions
    covered are counted from the sorted positions of the repeats.
    """
    pack = lambda i: F.shiftleft(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)), 32).bitwiseOR(i.cast("long"))
    index = F.when(F.size("w") >= 3, F.sequence(F.lit(0), F.size("w") - 3)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("i", index).withColumn("p", F.sort_array(F.transform("i", pack)))
    head = lambda x: F.shiftright(x, 32)
    near = lambda x, j: F.coalesce(head(x) == head(F.get("p", j + 1)), F.lit(False)) | F.coalesce(head(x) == head(F.get("p", j - 1)), F.lit(False))
    df = df.withColumn("cand", F.filter("p", near))
    place = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    exact = F.transform("cand", lambda x: F.struct(F.concat_ws(" ", F.slice("w", place(x) + 1, 3)).alias("g"), place(x).alias("at")))
    df = df.withColumn("exact", F.sort_array(exact))
    same = lambda x, j: F.coalesce(x["g"] == F.get("exact", j + 1)["g"], F.lit(False)) | F.coalesce(x["g"] == F.get("exact", j - 1)["g"], F.lit(False))
    df = df.withColumn("at", F.sort_array(F.transform(F.filter("exact", same), lambda x: x["at"])))
    gaps = F.transform("at", lambda x, j: F.least(F.lit(3), F.coalesce(F.get("at", j + 1) - x, F.lit(3))))
    return df.withColumn("n_repeat_words", F.aggregate(gaps, F.lit(0), lambda s, x: s + x).cast("long")).drop("w", "i", "p", "cand", "exact", "at")


def shares(counts: str) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def distance(p: str, q: str) -> Column:
    """Jensen-Shannon distance of two share arrays; 0 to 1."""

    def term(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda x, y: (term(x, y) + term(y, x)) / 2)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def mean_shares(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The mean of the share arrays for each value of ``keys`` (none: of all)."""
    out = None
    for name in ("classes", "frequent"):
        one = rows.select(*keys, F.posexplode(f"{name}_share").alias("pos", "x")).groupBy(*keys, "pos").agg(F.avg("x").alias("x"), F.count(F.lit(1)).alias("n"))
        one = one.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias(f"ref_{name}"), F.max("n").alias(f"n_{name}"))
        out = one if out is None else out.join(one, keys) if keys else out.crossJoin(one)
    return out


def with_references(rows: DataFrame, own: DataFrame) -> DataFrame:
    """``rows`` with the reference of their language in ``own``, or null.

    The most frequent languages, with a reference or not, are broadcast; rows
    of the others, none of which is frequent, meet theirs in a shuffle join.
    """
    counts = rows.filter("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    top = [r[0] for r in counts.orderBy(F.desc("_n"), "lang").limit(LANGS + 1).collect()]
    if len(top) <= LANGS:
        return rows.join(F.broadcast(own), "lang", "left")
    frequent = F.col("lang").isin(top[:LANGS])
    near = rows.filter(F.col("lang").isNull() | frequent).join(F.broadcast(own.filter(frequent)), "lang", "left")
    return near.unionByName(rows.filter(~frequent).join(own.filter(~frequent).hint("shuffle_hash"), "lang", "left"))


def quality(docs: DataFrame) -> DataFrame:
    """The verdict on every row of ``docs`` (doc_id, text, lang).

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, and the two distances (null where the
    document is too short for them or there is no reference). A null text has
    no words; a null language is compared with the mean of all documents;
    repeated rows are judged each; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = repeated_words(counted(docs)).withColumn("base_failed", failed)
    rows = rows.withColumn("classes_share", shares("classes")).withColumn("frequent_share", shares("frequent"))
    rows = stage(rows.drop("classes", "frequent"), "counted")
    steady = rows.filter(~F.col("base_failed") & (F.col("word_chars") >= MIN_CHARS) & (F.col("n_words") >= MIN_COMMON_WORDS))
    own = mean_shares(steady.filter("lang is not null"), ["lang"]).filter(F.col("n_classes") >= MIN_REFERENCE)
    own = stage(own.select("lang", "ref_classes", "ref_frequent"), "references")
    every = steady.select(F.lit("").alias("_all"), "classes_share", "frequent_share")
    whole = mean_shares(every, ["_all"]).select("_all", F.col("ref_classes").alias("all_classes"), F.col("ref_frequent").alias("all_frequent"))
    judged = with_references(rows, own).withColumn("_all", F.lit("")).join(F.broadcast(whole), "_all", "left")
    judged = judged.withColumn("rc", F.coalesce("ref_classes", "all_classes")).withColumn("rf", F.coalesce("ref_frequent", "all_frequent"))
    judged = judged.withColumn("class_distance", F.when(F.col("word_chars") >= MIN_CHARS, distance("classes_share", "rc")))
    judged = judged.withColumn("word_distance", F.when(F.col("n_words") >= MIN_COMMON_WORDS, distance("frequent_share", "rf")))
    far = F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False)) | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE + WORD_NOISE / F.sqrt("n_words"), F.lit(False))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    out = stage(judged.select(*names, (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance"), "quality")
    drop_stage(rows)
    drop_stage(own)
    return out


def op2_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    with arrow_settings(spark):
        return quality(docs)
