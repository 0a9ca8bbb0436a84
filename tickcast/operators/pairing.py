"""Pair the latest news message with the latest price message.

The reference keeps two slots per consumer; a message fills its slot
(an empty message empties it); when both slots hold a message the pair is
emitted and both slots are cleared. Keyed by symbol here.

Batch form, without a per-symbol fold. Look only at non-empty messages in
sequence order; message i of kind k emits exactly when

  * the previous non-empty message j has the other kind,
  * no empty message of j's kind came between j and i (it would have
    cleared j's slot), and
  * j itself did not emit (emitting clears both slots).

So with c_i = the first two conditions, emit_i = c_i AND NOT emit_{i-1}:
inside every maximal run ("island") of consecutive c = 1 messages the
emitters are the 1st, 3rd, 5th ... — a parity test on a position.

Hot symbols: a symbol may own a large share of all messages, so no window
runs over a whole symbol. Messages are cut into chunks of ``chunk_size``
consecutive sequence numbers; row-level windows run per (symbol, chunk)
(bounded groups). What crosses a chunk boundary — the previous non-empty
message, the empties seen since it, and the parity of the island running
into the chunk — is computed from one small summary row per chunk with
windows per symbol over those summaries (a two-level scan), then joined
back. Raw messages are shuffled once. The streaming form is
:mod:`tickcast.streaming.pairing`.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEWS = "news"
PRICES = "prices"
DEFAULT_CHUNK = 1 << 20


def empty_payload(value: str | Column) -> Column:
    """A message whose JSON array is empty (or absent/unparsable)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.json_array_length(v), F.lit(0)) <= 0


def pair_latest_reset(
    messages: DataFrame,
    key: str = "symbol",
    seq: str = "seq",
    kind: str = "kind",
    value: str = "value",
    empty: str | Column | None = None,
    chunk_size: int = DEFAULT_CHUNK,
    payload: bool = True,
    held: list[DataFrame] | None = None,
) -> DataFrame:
    """Messages (key, seq unique per key, kind news|prices, value) → one row
    per emitted pair: (key, seq of the emitting message, news_seq,
    prices_seq) and, with ``payload``, news_value and prices_value. The scan
    carries no payloads; they are joined to the emitted pairs by (key, seq).
    Frames persisted on the way are appended to ``held`` for the caller to
    release once the pairs are written."""
    held = [] if held is None else held
    is_empty = empty_payload(value) if empty is None else (F.col(empty) if isinstance(empty, str) else empty)
    m = messages.select(
        F.col(key).alias("_k"),
        F.col(seq).cast("long").alias("_seq"),
        F.col(kind).alias("_kind"),
        is_empty.alias("_empty"),
        F.floor(F.col(seq) / F.lit(chunk_size)).alias("_chunk"),
    )
    in_chunk = "PARTITION BY _k, _chunk ORDER BY _seq"
    run = f"OVER ({in_chunk} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = "OVER (PARTITION BY _k ORDER BY _chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    upto = "OVER (PARTITION BY _k ORDER BY _chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    news_empty = f"CAST(_empty AND _kind = '{NEWS}' AS BIGINT)"
    prices_empty = f"CAST(_empty AND _kind = '{PRICES}' AS BIGINT)"

    # 1. empties seen so far inside the chunk (inclusive running counts).
    #    Row-level frames feed both their chunk summary and the join back,
    #    so they are persisted: the log is scanned and shuffled once.
    m = m.selectExpr("*", f"sum({news_empty}) {run} AS _en", f"sum({prices_empty}) {run} AS _ep")
    m = m.persist(StorageLevel.MEMORY_AND_DISK)
    held.append(m)

    # 2. per chunk: empty totals and its last non-empty message
    chunks = m.groupBy("_k", "_chunk").agg(
        F.expr(f"sum({news_empty}) AS _tot_en"),
        F.expr(f"sum({prices_empty}) AS _tot_ep"),
        F.expr(
            "max(CASE WHEN NOT _empty THEN named_struct("
            "'seq', _seq, 'kind', _kind, 'en', _en, 'ep', _ep) END) AS _last"
        ),
    )
    # 3. per symbol over chunk rows: empties before the chunk and the last
    #    non-empty message of any earlier chunk (with global empty counts)
    chunks = chunks.selectExpr(
        "_k", "_chunk", "_last",
        f"coalesce(sum(_tot_en) {before}, 0) AS _cum_en",
        f"coalesce(sum(_tot_ep) {before}, 0) AS _cum_ep",
    ).selectExpr(
        "_k", "_chunk", "_cum_en", "_cum_ep",
        "last(CASE WHEN _last IS NOT NULL THEN named_struct('seq', _last.seq, 'kind', _last.kind, "
        "'en', _cum_en + _last.en, 'ep', _cum_ep + _last.ep) END, true) "
        f"{before} AS _carry",
    )

    # 4. non-empty rows with global empty counts; c_i from the previous
    #    non-empty message (in the chunk, else carried in)
    ne = m.filter("NOT _empty").join(chunks, ["_k", "_chunk"], "inner").selectExpr(
        "_k", "_chunk", "_seq", "_kind",
        "_cum_en + _en AS _gen",
        "_cum_ep + _ep AS _gep",
        "coalesce(lag(named_struct('seq', _seq, 'kind', _kind, "
        f"'en', _cum_en + _en, 'ep', _cum_ep + _ep)) OVER ({in_chunk}), _carry) AS _prev",
    )
    cleared = f"CASE WHEN _prev.kind = '{NEWS}' THEN _gen - _prev.en ELSE _gep - _prev.ep END"
    ne = ne.selectExpr("*", f"_prev IS NOT NULL AND _prev.kind != _kind AND ({cleared}) = 0 AS _c")
    ne = ne.selectExpr("*", f"sum(CAST(NOT _c AS BIGINT)) {run} AS _zeros")
    ne = ne.selectExpr("*", "row_number() OVER (PARTITION BY _k, _chunk, _zeros ORDER BY _seq) AS _pos")
    ne = ne.persist(StorageLevel.MEMORY_AND_DISK)
    held.append(ne)

    # 5. island parity entering each chunk: position of the previous
    #    non-empty chunk's last message inside its island (mod 2)
    par = ne.groupBy("_k", "_chunk").agg(
        F.expr("count(1) AS _n"), F.expr("max(_zeros) AS _z"), F.expr("max_by(_pos, _seq) AS _last_pos")
    )
    par = par.selectExpr("_k", "_chunk", "_z", "_last_pos", f"sum(_n) {upto} AS _cum_n").selectExpr(
        "_k", "_chunk", "_cum_n",
        f"last(CASE WHEN _z > 0 THEN named_struct('cum_n', _cum_n, 'r', _last_pos - 1) END, true) {upto} AS _anchor",
    )
    par = par.selectExpr(
        "_k", "_chunk",
        "lag((_anchor.r + _cum_n - _anchor.cum_n) % 2) OVER (PARTITION BY _k ORDER BY _chunk) AS _pin",
    )

    # 6. emit at odd positions of each island
    position = "CASE WHEN _zeros = 0 THEN _pin + _pos ELSE _pos - 1 END"
    emits = ne.join(par, ["_k", "_chunk"], "inner").filter(f"_c AND ({position}) % 2 = 1")
    news_now = f"_kind = '{NEWS}'"
    pairs = emits.selectExpr(
        f"_k AS `{key}`",
        f"_seq AS `{seq}`",
        f"CASE WHEN {news_now} THEN _seq ELSE _prev.seq END AS news_seq",
        f"CASE WHEN {news_now} THEN _prev.seq ELSE _seq END AS prices_seq",
    )
    if not payload:
        return pairs
    for side in (NEWS, PRICES):
        values = messages.select(key, F.col(seq).cast("long").alias(f"{side}_seq"), F.col(value).alias(f"{side}_value"))
        pairs = pairs.join(values, [key, f"{side}_seq"])
    return pairs.select(key, seq, "news_seq", "prices_seq", "news_value", "prices_value")
