"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Timestamp layout of ``time_published`` in the news payload,
# and the inclusive thresholds of the three-way daily label.
PUBLISHED_FORMAT = "yyyyMMdd'T'HHmmss"
BULLISH_AT = 0.35
BEARISH_AT = -0.35
BULLISH = "Bullish"
BEARISH = "Bearish"
NEUTRAL = "Neutral"

# Fixed value: JSON path of the current price inside a quote payload.
QUOTE_PRICE_PATH = "$.chart.result[0].meta.regularMarketPrice"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_published(c: str | Column, fmt: str = PUBLISHED_FORMAT) -> Column:
    """text → timestamp; malformed text gives NULL instead of raising."""
    return F.try_to_timestamp(col(c), F.lit(fmt))


def to_utc(c: str | Column, source_tz: str = "UTC") -> Column:
    """interpret a wall-clock timestamp in ``source_tz`` and return UTC.
    With the default zone it only turns a date string into a timestamp."""
    return F.to_utc_timestamp(col(c), source_tz)


def to_double(c: str | Column) -> Column:
    """F8: string → double, NULL on malformed text (ANSI-safe)."""
    return col(c).try_cast("double")


def sentiment_label(
    score: str | Column, bullish_at: float = BULLISH_AT, bearish_at: float = BEARISH_AT
) -> Column:
    """≥ bullish_at → Bullish, ≤ bearish_at → Bearish, else (also NULL) Neutral."""
    s = col(score)
    return (
        F.when(s >= F.lit(bullish_at), F.lit(BULLISH))
        .when(s <= F.lit(bearish_at), F.lit(BEARISH))
        .otherwise(F.lit(NEUTRAL))
    )


def processing_time(mode: str = "millis", now: str | None = None) -> Column:
    """processing time as epoch milliseconds (whole seconds × 1000,
    batch form) or as a timestamp (streaming form). ``now`` fixes the clock
    (an ISO timestamp string) so results are reproducible."""
    ts = F.to_timestamp(F.lit(now)) if now else F.current_timestamp()
    if mode == "millis":
        return (F.unix_timestamp(ts) * F.lit(1000)).cast("long")
    if mode == "timestamp":
        return to_utc(ts)
    raise ValueError(f"processing time mode must be 'millis' or 'timestamp', not {mode!r}")


def row_json(*cols: str | Column) -> Column:
    """row → JSON text that keeps NULL fields, so no column vanishes."""
    return F.to_json(F.struct(*[col(c) for c in cols]), {"ignoreNullFields": "false"})


def quote_price(payload: str | Column) -> Column:
    """current price out of a quote payload."""
    return F.get_json_object(col(payload), QUOTE_PRICE_PATH).try_cast("double")


def symbol_from_path(path: str | Column) -> Column:
    """Ticker from a landed file path.

    A Hive-style ``symbol=XYZ`` folder wins; otherwise the file name up to the
    first underscore (``AAPL_news_<ts>.json`` → ``AAPL``)."""
    p = col(path)
    from_dir = F.regexp_extract(p, r"(?:^|/)symbol=([^/]+)/", 1)
    file_name = F.regexp_extract(p, r"([^/]*)$", 1)
    from_name = F.split_part(file_name, F.lit("_"), F.lit(1))
    return F.when(from_dir != F.lit(""), from_dir).otherwise(from_name)


def index_name(symbol: str | Column) -> Column:
    """per-symbol document collection name."""
    return F.lower(col(symbol))


def snap(c: str | Column, scale: float = 1e6) -> Column:
    """Round half up to 1/scale with a double scale; used for reports that
    are compared across engines (plain round() differs on exact ties)."""
    k = float(scale)
    if isinstance(c, str):  # one JVM-side parse instead of a chain of calls
        return F.expr(f"floor(`{c}` * {k!r}D + 0.5D) / {k!r}D")
    return F.floor(c * F.lit(k) + F.lit(0.5)) / F.lit(k)
