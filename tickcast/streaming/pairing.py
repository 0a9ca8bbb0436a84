"""Pair-and-reset on the stream (T3), keyed by symbol.

State per symbol is two slots (the latest news and price message, with
their sequence numbers) — bounded no matter how long the stream runs. Each
micro-batch's messages of a symbol are applied in sequence order; an empty
message empties its slot; when both slots are full the pair is emitted and
both are cleared. The batch form is :func:`tickcast.operators.pairing.pair_latest_reset`.

:func:`pair_batches` runs that batch form on every micro-batch: the open slots
of a symbol are at most two messages written with the micro-batch, the scan
carries sequence numbers only, and a symbol that owns most of a micro-batch is
dealt over tasks by sequence chunks. :func:`pair_stream` is the form with state
in a streaming frame; it folds a symbol's micro-batch in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickcast.operators.pairing import DEFAULT_CHUNK, NEWS, PRICES, empty_payload, pair_latest_reset
from tickcast.sources.snapshots import remove, versions

PAIR_SCHEMA = (
    "symbol string, seq long, news_seq long, prices_seq long, news_value string, prices_value string"
)
STATE_SCHEMA = "news_seq long, news_value string, prices_seq long, prices_value string"
_COLUMNS = ["symbol", "seq", "news_seq", "prices_seq", "news_value", "prices_value"]


def _apply(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    slots = {NEWS: (None, None), PRICES: (None, None)}
    if state.exists:
        n_seq, n_val, p_seq, p_val = state.get
        slots = {NEWS: (n_seq, n_val), PRICES: (p_seq, p_val)}
    frames = [b for b in batches if len(b)]
    out = []
    if frames:
        msgs = pd.concat(frames).sort_values("seq", kind="stable")
        for seq, kind, value, empty in zip(msgs["seq"], msgs["kind"], msgs["value"], msgs["empty"]):
            slots[kind] = (None, None) if empty else (int(seq), value)
            if slots[NEWS][0] is not None and slots[PRICES][0] is not None:
                out.append((key[0], int(seq), slots[NEWS][0], slots[PRICES][0], slots[NEWS][1], slots[PRICES][1]))
                slots = {NEWS: (None, None), PRICES: (None, None)}
    state.update((slots[NEWS][0], slots[NEWS][1], slots[PRICES][0], slots[PRICES][1]))
    yield pd.DataFrame(out, columns=_COLUMNS)


def _messages(df: DataFrame, key: str, seq: str | Column, kind: str | None, news_topic: str, value: str) -> DataFrame:
    kind_col = F.col(kind) if kind else F.when(F.col("topic") == news_topic, F.lit(NEWS)).otherwise(F.lit(PRICES))
    seq_col = F.col(seq) if isinstance(seq, str) else seq
    return df.select(F.col(key).alias("symbol"), seq_col.cast("long").alias("seq"), kind_col.alias("kind"), F.col(value).alias("value"))


def pair_batches(
    slots: str,
    sink: Callable[[DataFrame, int], None],
    key: str = "key",
    seq: str | Column = "offset",
    kind: str | None = None,
    news_topic: str = "format_news_topic",
    value: str = "value",
    chunk_size: int = DEFAULT_CHUNK,
) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: pairs of each micro-batch, given to ``sink``.

    ``slots/v=<batch>`` holds the messages still in a slot after a micro-batch
    (at most one a symbol and kind); the next one reads them as its first
    messages, then takes its own in sequence order. The pairs are those of one
    run over the whole log however it is cut, as long as no micro-batch brings
    a message from before an earlier one's; such a message counts where its
    sequence number puts it among those not yet paired. A repeated micro-batch
    reads the slots of the one before and replaces its own. A NULL key is no
    symbol and is left out. Parameters as of :func:`pair_stream`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = _messages(batch, key, seq, kind, news_topic, value).filter(F.col("symbol").isNotNull())
        known = [v for v in versions(spark, slots) if v < batch_id]
        if known:
            own = own.unionByName(spark.read.schema(own.schema).parquet(f"{slots}/v={known[-1]}"))
        log, held = own.persist(), []
        pairs = pair_latest_reset(log, chunk_size=chunk_size, held=held).persist()
        try:
            emitted = pairs.groupBy("symbol").agg(F.max("seq").alias("_emit"))
            ends = log.groupBy("symbol", "kind").agg(
                F.max("seq").alias("seq"), F.max(F.when(~empty_payload("value"), F.col("seq"))).alias("_full")
            )
            left = ends.filter(F.col("seq") == F.col("_full")).join(emitted, "symbol", "left")
            left = left.filter(F.col("_emit").isNull() | (F.col("seq") > F.col("_emit"))).select("symbol", "kind", "seq")
            log.join(left, ["symbol", "kind", "seq"], "left_semi").select(*log.columns).write.mode("overwrite").parquet(f"{slots}/v={batch_id}")
            sink(pairs, batch_id)
            for v in known[:-1]:
                remove(spark, f"{slots}/v={v}")
        finally:
            for df in (pairs, *held, log):
                df.unpersist()

    return write


def pair_stream(
    messages: DataFrame,
    key: str = "key",
    seq: str | Column = "offset",
    kind: str | None = None,
    news_topic: str = "format_news_topic",
    value: str = "value",
) -> DataFrame:
    """Formatted messages (key = symbol) → stream of emitted pairs.

    ``seq`` orders a symbol's messages. Kafka offsets only order messages
    within one topic partition; when news and prices come from two topics,
    pass an order that spans both, e.g. ``F.unix_micros("timestamp")`` (the
    broker append time). ``kind`` names a column holding news|prices; by
    default it is derived from the topic (news topic → news, else prices)."""
    m = _messages(messages, key, seq, kind, news_topic, value).withColumn("empty", empty_payload("value"))
    return m.groupBy("symbol").applyInPandasWithState(
        _apply, PAIR_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )
