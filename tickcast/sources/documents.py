"""Readers for raw documents and message payloads.

Every reader takes a declared schema, so documents of any number of days,
files and symbols read together in one scan, with no inference pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickcast.schemas import DOCUMENT, META_DATA, META_SYMBOL, NEWS, PRICES, RAW_NEWS, RAW_PRICES, TIME_SERIES

CORRUPT = "_corrupt_record"


def read_raw_news(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """News documents from JSON files (a glob or a list), with the file
    path kept so the ticker can also come from the file name (P12)."""
    reader = spark.read.schema(RAW_NEWS).option("multiLine", str(multiline).lower())
    df = reader.json(path)
    return df.withColumn("_path", F.col("_metadata.file_path"))


def read_stamps(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(ticker, ingest_ts) that :func:`land` stamped on each document."""
    raw = spark.read.schema("ticker string, ingest_ts string").json(path)
    return raw.select("ticker", F.col("ingest_ts").try_cast("timestamp").alias("ingest_ts"))


def read_raw_prices(spark: SparkSession, path: str | list[str], multiline: bool = False) -> DataFrame:
    """Price documents from JSON files; the daily series is a map, so
    files with different days share one schema. Pretty-printed upstream
    files need ``multiline=True``."""
    reader = spark.read.schema(RAW_PRICES).option("multiLine", str(multiline).lower())
    df = reader.json(path)
    return df.withColumn("_path", F.col("_metadata.file_path"))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _reason(get, kind: str) -> Column:
    """Why a parsed document can't be formatted, NULL if it can."""
    broken = F.when(get(CORRUPT).isNotNull(), F.lit("broken"))
    if kind == "news":
        return broken.when(get("feed").isNull(), F.lit("no feed"))
    return broken.when(get(TIME_SERIES).isNull(), F.lit("no series")).when(get(META_DATA)[META_SYMBOL].isNull(), F.lit("no symbol"))


def malformed_documents(spark: SparkSession, path: str | list[str], kind: str) -> DataFrame:
    """S1/S2 quarantine: (path, reason, record) of the landed documents of
    ``kind`` (news or prices) that formatting gets no rows from: broken JSON,
    or JSON without a feed, or without a daily series and its symbol.
    ``record`` is null where the JSON itself is whole."""
    schema = _with_corrupt(RAW_NEWS if kind == "news" else RAW_PRICES)
    raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    flagged = raw.withColumn("path", F.col("_metadata.file_path")).withColumn("reason", _reason(lambda c: F.col(f"`{c}`"), kind))
    return flagged.filter(F.col("reason").isNotNull()).select("path", "reason", F.col(CORRUPT).alias("record"))


def rejection(value: Column, kind: str) -> Column:
    """Why a message holds no document of ``kind`` that can be formatted;
    NULL if it does. A NULL message is broken."""
    schema = _with_corrupt(RAW_NEWS if kind == "news" else RAW_PRICES)
    doc = F.from_json(value, schema, {"columnNameOfCorruptRecord": CORRUPT})
    return F.when(value.isNull(), F.lit("broken")).otherwise(_reason(lambda c: doc[c], kind))


def valid_document(value: Column, kind: str) -> Column:
    """Whether a message holds a document of ``kind`` that can be formatted."""
    return rejection(value, kind).isNull()


def combined_rows(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """S5 + P7: combined messages (one JSON row each) → typed document rows."""
    rows = df.select(*(keep or []), F.from_json(value, DOCUMENT).alias("_d"))
    return rows.select(*(keep or []), "_d.*")


def parse_news(value: str | Column) -> Column:
    """S3: one news document per message value."""
    return F.from_json(F.col(value) if isinstance(value, str) else value, RAW_NEWS)


def parse_prices(value: str | Column) -> Column:
    """One price document per message value."""
    return F.from_json(F.col(value) if isinstance(value, str) else value, RAW_PRICES)


def as_json_schema(schema: T.StructType) -> T.StructType:
    """Wire schema of a row-batch message: timestamps travel as text."""
    fields = []
    for f in schema.fields:
        t = T.StringType() if isinstance(f.dataType, (T.TimestampType, T.DateType)) else f.dataType
        fields.append(T.StructField(f.name, t))
    return T.StructType(fields)


def explode_row_batches(df: DataFrame, schema: T.StructType, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """S5 + P6: message = JSON array of JSON-row texts → typed rows.

    Each element is parsed with the declared row schema, then cast to the
    layer types with ``try_cast`` (malformed values become NULL)."""
    keep = keep or []
    elems = df.select(*keep, F.explode(F.from_json(F.col(value), "array<string>")).alias("_e"))
    parsed = elems.select(*keep, F.from_json("_e", as_json_schema(schema)).alias("_r"))
    return parsed.select(
        *keep, *[F.col(f"_r.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def news_rows(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    return explode_row_batches(df, NEWS, value, keep)


def price_rows(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    return explode_row_batches(df, PRICES, value, keep)
