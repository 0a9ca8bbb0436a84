"""Writers: landing (S11), Parquet (S7), messages (S9), per-symbol documents
(S10). All writes are Spark writers running in parallel; nothing is
serialised on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickcast.functions.scalar import index_name, row_json
from tickcast.schemas import DOCUMENT
from tickcast.sources.compaction import load_documents, newest


def stamped(value: Column, symbol: Column, at: Column | str | None = None) -> Column:
    """F17 + S11: a JSON document with ``ticker`` and ``ingest_ts`` as its last
    fields, so they hold against fields of that name in the document. Text that
    doesn't end like an object is landed as it is."""
    when = F.current_timestamp() if at is None else (F.lit(at) if isinstance(at, str) else at).cast("timestamp")
    stamp = F.to_json(F.struct(symbol.alias("ticker"), F.date_format(when, "yyyy-MM-dd HH:mm:ss").alias("ingest_ts")))
    rest = F.substring(stamp, 2, 1 << 30)
    # most texts end in their brace after a value: these are not searched through
    plain = F.right(value, F.lit(2)).rlike(r"^[^\s{\x85\u2028\u2029]\}$")
    body = F.regexp_replace(value, r"\s*\}\s*$", "")
    comma = F.when(body.rlike(r"\{\s*$"), F.lit("")).otherwise(F.lit(","))
    other = F.when(value.rlike(r"\}\s*$"), F.concat(body, comma, rest)).otherwise(value)
    return F.when(plain, F.concat(F.left(value, F.length(value) - 1), F.lit(","), rest)).otherwise(other)


def land(
    docs: DataFrame,
    path: str,
    kind: str,
    value: str = "value",
    mode: str = "append",
    files_per_symbol: int | None = None,
    ingested_at: Column | str | None = None,
) -> None:
    """S11 + F17: raw JSON documents to ``path/kind=<kind>/symbol=<s>/``.

    The reference writes one object per ticker, kind and second; here the
    layout carries kind and symbol, and the document text is written as is
    (one document per line). For bulk landings, ``files_per_symbol`` bounds
    the files per symbol: documents are spread by a hash of their text over
    that many writer tasks per symbol (a hot symbol still uses several).

    Every document gets its ticker and the time of ingestion (now, or
    ``ingested_at``); see :func:`stamped`."""
    rows = docs.select(stamped(F.col(value), F.col("symbol"), ingested_at).alias("value"), F.lit(kind).alias("kind"), "symbol")
    if files_per_symbol:
        salt = F.pmod(F.xxhash64("value"), F.lit(int(files_per_symbol)))
        rows = rows.repartition("kind", "symbol", salt)
    rows.write.mode(mode).partitionBy("kind", "symbol").text(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Parquet sink. Default save mode as in the reference; pass
    ``mode="overwrite"`` with dynamic partition overwrite for reruns."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def to_messages(df: DataFrame, key: str = "symbol") -> DataFrame:
    """S9 + F12: one message per row (key, value) with NULL fields kept —
    what a topic writer (``format("kafka")``) consumes."""
    return df.select(F.col(key).cast("string").alias("key"), row_json(*df.columns).alias("value"))


def row_batches(df: DataFrame, group: list[str], columns: list[str] | None = None) -> DataFrame:
    """S9 in the reference's message shape: a JSON array of JSON-row texts
    per group. Callers pick groups of bounded size (one fetch, one day)."""
    columns = columns or [c for c in df.columns if c not in group]
    rows = df.select(*group, row_json(*columns).alias("_row"))
    return rows.groupBy(*group).agg(F.to_json(F.collect_list("_row")).alias("value"))


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Idempotent micro-batch write for ``foreachBatch``: the batch lands in
    its own ``_batch=<id>`` partition with dynamic partition overwrite, so a
    micro-batch re-run after a failure replaces its output instead of
    appending it twice."""
    (
        df.withColumn("_batch", F.lit(int(batch_id)).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(partition_by or []), "_batch")
        .format(fmt)
        .save(path)
    )


def typed_documents(combined: DataFrame, date_as_timestamp: bool = False) -> DataFrame:
    """The typed index document (counts → int). The processing time
    keeps the type it was produced with (epoch millis or timestamp). The
    streaming indexer of the reference re-casts ``date`` to a timestamp;
    ``date_as_timestamp`` does the same (default keeps the date)."""
    cols = []
    for f in DOCUMENT.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name))
        elif f.name == "date" and date_as_timestamp:
            cols.append(F.col("date").cast("timestamp").alias("date"))
        else:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return combined.select(*cols)


def write_documents(
    combined: DataFrame,
    path: str,
    mode: str = "append",
    load_id: int | Column | None = None,
    fmt: str = "parquet",
    batch_id: int | None = None,
    date_as_timestamp: bool = False,
) -> None:
    """One document per row into a per-symbol collection
    ``index=<lower(symbol)>`` (F14), created on first write.

    ``append`` is the reference's behaviour (a rerun duplicates documents).
    ``upsert`` appends with a load sequence; :func:`read_documents` then
    returns the newest document per (symbol, date) — merge on read, so no
    path is rewritten while it is being read. With ``batch_id`` (streaming)
    the write is idempotent per micro-batch (:func:`write_batch`)."""
    docs = typed_documents(combined, date_as_timestamp).withColumn("index", index_name("symbol"))
    if mode == "upsert":
        load = load_id if isinstance(load_id, Column) else F.lit(load_id if load_id is not None else 0)
        docs = docs.withColumn("_load", load.cast("long"))
    elif mode != "append":
        raise ValueError(f"documents mode must be 'append' or 'upsert', not {mode!r}")
    # One writer task per collection: documents are one row per symbol and
    # day (bounded), and without this every task would leave a small file
    # in every collection it touches (tasks × symbols files).
    docs = docs.repartition("index").sortWithinPartitions("index", "date")
    if batch_id is not None:
        write_batch(docs, path, batch_id, ["index"], fmt)
        return
    docs.write.mode("append").partitionBy("index").format(fmt).save(path)


# Stored document columns (batch processing time as epoch millis).
DOCUMENT_STORED = (
    "symbol string, date date, close_price double, close_price_prediction double, "
    "positive_news_amount int, negative_news_amount int, ticker_sentiment_score_mean double, "
    "ticker_sentiment_score_mean_label string, overall_sentiment_score_mean double, "
    "overall_sentiment_score_mean_label string, timestamp long, current_price double, index string"
)


def read_documents(
    spark: SparkSession, path: str, fmt: str = "parquet", resolve: bool = True, schema: str | None = None
) -> DataFrame:
    """Read documents back; with ``resolve`` and upserted data, keep the
    newest load per (symbol, date) as one aggregate (map-side partial).
    Appended data (no load id) keeps every row: two pairs of one symbol and
    day in a micro-batch are two documents.
    A declared ``schema`` also reads a collection that is still empty.
    A compacted collection (:mod:`tickcast.sources.compaction`) reads alike."""
    docs = load_documents(spark, path, fmt, schema)
    if resolve:
        docs = newest(docs)
    elif "_load" in docs.columns and "_batch" in docs.columns:
        docs = docs.withColumn("_load", F.struct("_load", "_batch"))
    return docs.drop("_batch", "_load") if resolve else docs.drop("_batch")
