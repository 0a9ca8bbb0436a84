"""The corpus pipeline: the stages of training-data preparation in order.

Each stage takes (spark, docs, sf_dir) with ``docs`` what the stage before
kept, and returns a DataFrame with the columns of ``documents`` (the last one:
the packed pieces). Texts change with a stage's decisions; n_chars follows.
Stages return plans, so that a stage's rows are written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickcast.llm.bpe import vocabulary
from tickcast.llm.common import arrow_settings, drop_stage, stage
from tickcast.llm.hyperminhash import keep_one
from tickcast.llm.language import held_out, identify, train
from tickcast.llm.packing import pack_documents
from tickcast.llm.pii import mask_pii
from tickcast.llm.suffix_dedup import remove_repeats

#: SQL can't express these stages; tests/llm hold them against brute force.
ORACLE_SQL = None

#: Similarity of five-word shingle sets from which documents are near copies.
NEAR_PERCENT = 80


def measured(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast(kind))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in no language (null, empty or without letters); a null
    lang becomes the predicted one. The model learns from the rows with a lang
    outside the held-out fold; without any, lang stays null. Repeated rows are
    judged each, extra columns are kept as they are (also ones named like the
    model's own), an empty table stays empty."""
    with arrow_settings(spark):
        model = train(docs.filter(~held_out() & F.col("doc_id").isNotNull()))
    written = docs.filter(F.col("text").rlike(r"\p{L}"))
    if model is None:
        return written
    aside = {c: f"__own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    named = identify(written.withColumnsRenamed(aside), model).filter(F.col("lang_pred") != "und")
    named = named.withColumn("lang", F.coalesce("lang", "lang_pred")).drop("lang_pred", "score")
    return named.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each near-duplicate group; rows of one
    doc_id, null ids and texts without words all stay. Extra columns are kept,
    an empty table stays empty."""
    return keep_one(docs, NEAR_PERCENT)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts byte strings of 100 bytes that also start earlier out of the texts;
    documents of which nothing but white space is left go (so do null and empty
    texts). Repeated rows count once, a null id takes no part and stays."""
    cut = remove_repeats(docs).filter(F.length(F.regexp_replace("text", r"\s", "")) > 0)
    return measured(cut)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind; null and empty texts and
    extra columns stay as they are."""
    return measured(mask_pii(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token pieces of all documents into sequences; a null or empty
    text still gives its end id, repeated rows are packed each."""
    return pack_documents(docs, vocabulary(), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("pii", pii),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage returns a plan; its rows are written once, and what it read
    is deleted as soon as they are."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            drop_stage(before)
        before = docs
    out = STAGES[-1][1](spark, docs, sf_dir)
    drop_stage(before)
    return out
