from tickcast.functions.scalar import (  # noqa: F401
    BEARISH,
    BEARISH_AT,
    BULLISH,
    BULLISH_AT,
    NEUTRAL,
    PUBLISHED_FORMAT,
    index_name,
    parse_published,
    processing_time,
    quote_price,
    row_json,
    sentiment_label,
    snap,
    symbol_from_path,
    to_double,
    to_utc,
)
