"""DuckDB SQL that states each registered query independently of the Spark
plan (tables ``events orders lineitem customer ...`` are views).

Where the Spark side uses a shortcut (the window form of the shifted right
join, the anti-join-free fallback, the moment-based OLS), the SQL here
spells out the reference's formulation instead: a real right join, an inner
join plus ``NOT EXISTS`` fallback, and least squares by successive
residualisation (Gram-Schmidt) with window aggregates.
"""

from __future__ import annotations

from tickcast.schemas import FEATURES, PRICE_MEASURES


def snap(x: str, scale: float = 1e6) -> str:
    return f"floor(({x}) * {float(scale)!r} + 0.5) / {float(scale)!r}"


def iso_date(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def iso_time(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def label5(x: str) -> str:
    return (
        f"CASE WHEN {x} <= -0.35 THEN 'Bearish' WHEN {x} <= -0.15 THEN 'Somewhat-Bearish' "
        f"WHEN {x} < 0.15 THEN 'Neutral' WHEN {x} < 0.35 THEN 'Somewhat-Bullish' "
        f"WHEN {x} IS NOT NULL THEN 'Bullish' END"
    )


def label3(x: str) -> str:
    return f"CASE WHEN {x} >= 0.35 THEN 'Bullish' WHEN {x} <= -0.35 THEN 'Bearish' ELSE 'Neutral' END"


EV = """ev AS (
  SELECT *, 'S' || CAST(user_id % 5 AS VARCHAR) AS symbol
  FROM events)"""

MIXED = """mixed AS (
  SELECT symbol, CASE WHEN event_type = 'purchase' THEN 'ingest_prices_topic' ELSE 'ingest_news_topic' END AS topic,
         CASE WHEN event_type = 'error' THEN 'broken'
              WHEN event_type = 'signup' THEN 'no feed'
              WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN 'no series'
              WHEN event_type = 'purchase' AND event_id % 4 = 1 THEN 'no symbol' END AS reason
  FROM ev)"""

EV_BARS = """bars AS (
  SELECT symbol, CAST(ts AS DATE) AS date,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close, arg_max(value, event_id) AS adjusted_close,
         sum(value) AS volume, CAST(0.0 AS DOUBLE) AS dividend_amount,
         CAST(1.0 AS DOUBLE) AS split_coefficient
  FROM ev WHERE event_type = 'purchase'
  GROUP BY symbol, CAST(ts AS DATE))"""

EV_NEWS = f"""news AS (
  SELECT event_id, date_trunc('second', ts) AS time_published, symbol AS ticker,
         (value - 50.0) / 100.0 AS ticker_sentiment_score,
         {label5('(value - 50.0) / 100.0')} AS ticker_sentiment_label,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS relevance_score,
         (value - 40.0) / 100.0 AS overall_sentiment_score,
         {label5('(value - 40.0) / 100.0')} AS overall_sentiment_label
  FROM ev WHERE event_type IN ('view', 'click', 'signup'))"""

SEG = """seg AS (
  SELECT o_orderkey, o_totalprice, o_orderdate, o_orderpriority,
         c_mktsegment AS symbol, c_acctbal
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

ORD_BARS = """bars AS (
  SELECT symbol, CAST(l_shipdate AS DATE) AS date,
         arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS open,
         max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
         arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS close,
         arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS adjusted_close,
         sum(l_quantity) AS volume, CAST(0.0 AS DOUBLE) AS dividend_amount,
         CAST(1.0 AS DOUBLE) AS split_coefficient
  FROM lineitem JOIN seg ON l_orderkey = o_orderkey
  GROUP BY symbol, CAST(l_shipdate AS DATE))"""

SUPP_BARS = """bars AS (
  SELECT 'P' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
         arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey)) AS open,
         max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
         arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey)) AS close,
         arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey)) AS adjusted_close,
         sum(l_quantity) AS volume, CAST(0.0 AS DOUBLE) AS dividend_amount,
         CAST(1.0 AS DOUBLE) AS split_coefficient
  FROM lineitem GROUP BY 1, 2)"""

ORD_NEWS = f"""news AS (
  SELECT CAST(o_orderdate AS TIMESTAMP) AS time_published, symbol AS ticker,
         (o_totalprice - 250000.0) / 250000.0 AS ticker_sentiment_score,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Bullish' WHEN '2-HIGH' THEN 'Somewhat-Bullish'
              WHEN '3-MEDIUM' THEN 'Neutral' WHEN '4-NOT SPECIFIED' THEN 'Somewhat-Bearish'
              WHEN '5-LOW' THEN 'Bearish' END AS ticker_sentiment_label,
         CAST(1.0 AS DOUBLE) AS relevance_score,
         c_acctbal / 10000.0 AS overall_sentiment_score,
         {label5('c_acctbal / 10000.0')} AS overall_sentiment_label
  FROM seg)"""

DAILY = f"""daily AS (
  SELECT ticker AS symbol, CAST(time_published AS DATE) AS date,
         CAST(sum(CASE WHEN ticker_sentiment_label = 'Bullish' THEN 1 ELSE 0 END) AS BIGINT) AS positive_news_amount,
         CAST(sum(CASE WHEN ticker_sentiment_label = 'Bearish' THEN 1 ELSE 0 END) AS BIGINT) AS negative_news_amount,
         avg(ticker_sentiment_score) AS ticker_sentiment_score_mean,
         avg(overall_sentiment_score) AS overall_sentiment_score_mean
  FROM news GROUP BY 1, 2),
daily_l AS (
  SELECT *, {label3('ticker_sentiment_score_mean')} AS ticker_sentiment_score_mean_label,
         {label3('overall_sentiment_score_mean')} AS overall_sentiment_score_mean_label
  FROM daily)"""


def labelled(as_of: str) -> str:
    """``lab``: bars + next close + the training flag (no NULL/NaN anywhere)."""
    cols = ["open", "high", "low", "close", "adjusted_close", "volume", "dividend_amount", "split_coefficient", "y"]
    complete = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in cols)
    return f"""lab0 AS (
  SELECT *, lead(close) OVER (PARTITION BY symbol ORDER BY date) AS y FROM bars),
lab AS (
  SELECT *, (date < DATE '{as_of}' AND symbol IS NOT NULL AND date IS NOT NULL AND {complete}) AS t
  FROM lab0)"""


def ols(features: list[str] | None = None, src: str = "lab", out: str = "fit") -> str:
    """Least squares per symbol by successive residualisation.

    z_1 = x_1 - mean(x_1); z_j = x_j - mean(x_j) - Σ_{i<j} cov(x_j, z_i)/var(z_i)·z_i;
    ŷ = mean(y) + Σ_j cov(y, z_j)/var(z_j)·z_j. Moments over training rows
    only (t), per symbol. A z_j with no variance left (a constant or
    collinear feature) contributes nothing.
    """
    features = list(features or FEATURES)
    w = "OVER (PARTITION BY symbol)"

    def tv(x: str) -> str:
        return f"CASE WHEN t THEN {x} END"

    def coef(a: str, j: int) -> str:
        return (
            f"CASE WHEN a_{j} THEN covar_pop({tv(a)}, {tv(f'z_{j}')}) {w} / var_pop({tv(f'z_{j}')}) {w} ELSE 0 END"
        )

    ctes = []
    means = ", ".join(f"avg({tv(f)}) {w} AS m_{i}" for i, f in enumerate(features))
    ctes.append(f"g0 AS (SELECT *, avg({tv('y')}) {w} AS m_y, {means} FROM {src})")
    prev = "g0"
    for j, f in enumerate(features):
        resid = f"({f} - m_{j})"
        for i in range(j):
            resid += f" - ({coef(f, i)}) * z_{i}"
        ctes.append(f"g{j}z AS (SELECT *, {resid} AS z_{j} FROM {prev})")
        ctes.append(
            f"g{j}a AS (SELECT *, coalesce(var_pop({tv(f'z_{j}')}) {w} > 1e-12 * var_pop({tv(f)}) {w}, false) AS a_{j} FROM g{j}z)"
        )
        prev = f"g{j}a"
    yhat = "m_y" + "".join(f" + ({coef('y', j)}) * z_{j}" for j in range(len(features)))
    ctes.append(f"{out} AS (SELECT *, {yhat} AS yhat FROM {prev})")
    return ",\n".join(ctes)


def ols_grouped(features: list[str] | None = None, src: str = "lab", out: str = "fit") -> str:
    """The fit of :func:`ols` for many symbols: every moment is one grouped
    aggregate that is joined back, each step materialised once."""
    features = list(features or FEATURES)

    def slope(a: str, j: int) -> str:
        return f"CASE WHEN any_value(a_{j}) THEN covar_pop({a}, z_{j}) FILTER (t) / var_pop(z_{j}) FILTER (t) ELSE 0 END"

    means = ", ".join(f"avg({f}) FILTER (t) AS m_{i}" for i, f in enumerate(features))
    ctes = [
        f"o_m AS MATERIALIZED (SELECT symbol, avg(y) FILTER (t) AS m_y, {means} FROM {src} GROUP BY symbol)",
        f"o_0 AS MATERIALIZED (SELECT * FROM {src} JOIN o_m USING (symbol))",
    ]
    for j, f in enumerate(features):
        prev = f"o_{j}"
        known = "".join(f", {slope(f, i)} AS k_{j}_{i}" for i in range(j))
        ctes.append(f"c_{j} AS MATERIALIZED (SELECT symbol{known} FROM {prev} GROUP BY symbol)")
        resid = f"({f} - m_{j})" + "".join(f" - k_{j}_{i} * z_{i}" for i in range(j))
        ctes.append(f"r_{j} AS MATERIALIZED (SELECT *, {resid} AS z_{j} FROM {prev} JOIN c_{j} USING (symbol))")
        ctes.append(f"v_{j} AS MATERIALIZED (SELECT symbol, coalesce(var_pop(z_{j}) FILTER (t) > 1e-12 * var_pop({f}) FILTER (t), false) AS a_{j} FROM r_{j} GROUP BY symbol)")
        ctes.append(f"o_{j + 1} AS MATERIALIZED (SELECT * FROM r_{j} JOIN v_{j} USING (symbol))")
    last = f"o_{len(features)}"
    slopes = ", ".join(f"{slope('y', j)} AS b_{j}" for j in range(len(features)))
    ctes.append(f"c_y AS MATERIALIZED (SELECT symbol, {slopes} FROM {last} GROUP BY symbol)")
    yhat = "m_y" + "".join(f" + b_{j} * z_{j}" for j in range(len(features)))
    ctes.append(f"{out} AS MATERIALIZED (SELECT *, {yhat} AS yhat FROM {last} JOIN c_y USING (symbol))")
    return ",\n".join(ctes)


def predicted(as_of: str, fit=ols) -> str:
    """``pred``: the reference's right join of prices to predictions moved
    one calendar day forward (ON symbol and date)."""
    measures = ", ".join(f"lab.{m} AS {m}" for m in PRICE_MEASURES)
    return f"""{labelled(as_of)},
{fit()},
shifted AS (SELECT symbol, date + 1 AS date, yhat AS prediction FROM fit WHERE date <= DATE '{as_of}'),
pred AS (
  SELECT shifted.symbol AS symbol, shifted.date AS date, {measures},
         lab.y AS next_day_close, shifted.prediction AS prediction
  FROM lab RIGHT JOIN shifted ON lab.symbol = shifted.symbol AND lab.date = shifted.date)"""


def combined(as_of: str, now_millis: int) -> str:
    """``comb``: inner join + NOT EXISTS fallback + latest-close quote."""
    agg_cols = (
        "d.positive_news_amount, d.negative_news_amount, d.ticker_sentiment_score_mean, "
        "d.ticker_sentiment_score_mean_label, d.overall_sentiment_score_mean, d.overall_sentiment_score_mean_label"
    )
    return f"""{predicted(as_of)},
inner_rows AS (
  SELECT p.symbol AS symbol, p.date AS date, p.close AS close_price,
         p.prediction AS close_price_prediction, {agg_cols}
  FROM pred p JOIN daily_l d ON p.symbol = d.symbol AND p.date = d.date),
fallback_rows AS (
  SELECT d.symbol AS symbol, d.date AS date, CAST(0.0 AS DOUBLE) AS close_price,
         CAST(0.0 AS DOUBLE) AS close_price_prediction, {agg_cols}
  FROM daily_l d
  WHERE NOT EXISTS (SELECT 1 FROM inner_rows i WHERE i.symbol = d.symbol)),
quotes AS (SELECT symbol, arg_max(close, date) AS current_price FROM bars GROUP BY symbol),
comb AS (
  SELECT u.*, CAST({now_millis} AS BIGINT) AS timestamp, q.current_price AS current_price
  FROM (SELECT * FROM inner_rows UNION ALL SELECT * FROM fallback_rows) u
  LEFT JOIN quotes q ON u.symbol = q.symbol)"""


def combined_select(src: str = "comb") -> str:
    return f"""SELECT symbol, {iso_date('date')} AS date, {snap('close_price')} AS close_price,
       {snap('close_price_prediction')} AS close_price_prediction,
       positive_news_amount, negative_news_amount,
       {snap('ticker_sentiment_score_mean', 1e9)} AS ticker_sentiment_score_mean,
       ticker_sentiment_score_mean_label,
       {snap('overall_sentiment_score_mean', 1e9)} AS overall_sentiment_score_mean,
       overall_sentiment_score_mean_label, timestamp,
       {snap('current_price')} AS current_price
FROM {src}"""


def documents_select(src: str) -> str:
    """Typed index documents (counts as INTEGER) with the collection name."""
    return f"""SELECT symbol, {iso_date('date')} AS date, {snap('close_price')} AS close_price,
       {snap('close_price_prediction')} AS close_price_prediction,
       CAST(positive_news_amount AS INTEGER) AS positive_news_amount,
       CAST(negative_news_amount AS INTEGER) AS negative_news_amount,
       {snap('ticker_sentiment_score_mean', 1e9)} AS ticker_sentiment_score_mean,
       ticker_sentiment_score_mean_label,
       {snap('overall_sentiment_score_mean', 1e9)} AS overall_sentiment_score_mean,
       overall_sentiment_score_mean_label, timestamp,
       {snap('current_price')} AS current_price, lower(symbol) AS "index"
FROM {src}"""


# Pair-and-reset as the reference's two-slot fold, message by message, with a
# recursive CTE: independent of the window form used on the Spark side.
PAIR_FOLD = """WITH RECURSIVE msgs AS (
  SELECT 'S' || CAST(user_id % 5 AS VARCHAR) AS symbol, event_id AS seq,
         CASE WHEN event_type = 'purchase' THEN 'prices' ELSE 'news' END AS kind,
         event_type = 'error' AS empty,
         row_number() OVER (PARTITION BY 'S' || CAST(user_id % 5 AS VARCHAR) ORDER BY event_id) AS rn
  FROM events),
fold(symbol, rn, n_seq, p_seq, e_seq, e_news, e_prices) AS (
  SELECT DISTINCT symbol, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
         CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM msgs
  UNION ALL
  SELECT symbol, rn,
         CASE WHEN emit THEN NULL WHEN kind = 'news' THEN (CASE WHEN empty THEN NULL ELSE seq END) ELSE n_seq END,
         CASE WHEN emit THEN NULL WHEN kind = 'prices' THEN (CASE WHEN empty THEN NULL ELSE seq END) ELSE p_seq END,
         CASE WHEN emit THEN seq END,
         CASE WHEN emit THEN (CASE WHEN kind = 'news' THEN seq ELSE n_seq END) END,
         CASE WHEN emit THEN (CASE WHEN kind = 'prices' THEN seq ELSE p_seq END) END
  FROM (SELECT f.symbol, m.rn, m.kind, m.empty, m.seq, f.n_seq, f.p_seq,
               (NOT m.empty AND ((m.kind = 'news' AND f.p_seq IS NOT NULL)
                                 OR (m.kind = 'prices' AND f.n_seq IS NOT NULL))) AS emit
        FROM fold f JOIN msgs m ON m.symbol = f.symbol AND m.rn = f.rn + 1) s)
SELECT symbol, e_seq AS seq, e_news AS news_seq, e_prices AS prices_seq
FROM fold WHERE e_seq IS NOT NULL"""


def daily_select(src: str = "daily_l") -> str:
    return f"""SELECT symbol, {iso_date('date')} AS date, positive_news_amount, negative_news_amount,
       {snap('ticker_sentiment_score_mean', 1e9)} AS ticker_sentiment_score_mean,
       ticker_sentiment_score_mean_label,
       {snap('overall_sentiment_score_mean', 1e9)} AS overall_sentiment_score_mean,
       overall_sentiment_score_mean_label
FROM {src}"""


def news_select(src: str = "news") -> str:
    return f"""SELECT {iso_time('time_published')} AS time_published, ticker,
       {snap('ticker_sentiment_score', 1e9)} AS ticker_sentiment_score, ticker_sentiment_label,
       {snap('relevance_score', 1e9)} AS relevance_score,
       {snap('overall_sentiment_score', 1e9)} AS overall_sentiment_score, overall_sentiment_label
FROM {src}"""


def bars_select(src: str = "bars", extra: str = "") -> str:
    measures = ", ".join(f"{snap(m)} AS {m}" for m in PRICE_MEASURES)
    return f"SELECT symbol, {iso_date('date')} AS date, {measures}{extra} FROM {src}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def stream_combined(as_of: str, now: str, block: int, fetch: int, history: int, first: str) -> str:
    """Streaming combine: document-level messages (news: one per (symbol,
    block of event ids); prices: one per (symbol, longer block), with the
    ``history`` days before the block's last day), paired by the
    two-slot fold, then each pair combined on its own rows (inner join
    only, processing time as a timestamp)."""
    pair_bars = EV_BARS.replace("bars AS (", "bars0 AS (")
    news_cols = EV_NEWS[EV_NEWS.index("SELECT") + len("SELECT"):EV_NEWS.index("FROM ev")]
    news_cols = news_cols.replace("symbol AS ticker,", "p.symbol || '#' || CAST(p.pseq AS VARCHAR) AS ticker,")
    return f"""WITH RECURSIVE {EV},
{pair_bars},
nb AS (
  SELECT symbol, floor(event_id / {block}) AS block, max(event_id) AS seq,
         count(*) FILTER (WHERE event_type IN ('view', 'click', 'signup')) = 0 AS empty
  FROM ev WHERE event_type <> 'purchase' GROUP BY 1, 2),
pm AS (
  SELECT * FROM (
    SELECT symbol, floor(event_id / {fetch}) AS part, max(event_id) AS seq, max(CAST(ts AS DATE)) AS day
    FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2)
  WHERE day >= DATE '{first}'),
msgs AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY seq) AS rn FROM (
    SELECT symbol, seq, 'news' AS kind, empty FROM nb
    UNION ALL SELECT symbol, seq, 'prices' AS kind, false AS empty FROM pm)),
fold(symbol, rn, n_seq, p_seq, e_seq, e_news, e_prices) AS (
  SELECT DISTINCT symbol, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
         CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)
  FROM msgs
  UNION ALL
  SELECT symbol, rn,
         CASE WHEN emit THEN NULL WHEN kind = 'news' THEN (CASE WHEN empty THEN NULL ELSE seq END) ELSE n_seq END,
         CASE WHEN emit THEN NULL WHEN kind = 'prices' THEN (CASE WHEN empty THEN NULL ELSE seq END) ELSE p_seq END,
         CASE WHEN emit THEN seq END,
         CASE WHEN emit THEN (CASE WHEN kind = 'news' THEN seq ELSE n_seq END) END,
         CASE WHEN emit THEN (CASE WHEN kind = 'prices' THEN seq ELSE p_seq END) END
  FROM (SELECT f.symbol, m.rn, m.kind, m.empty, m.seq, f.n_seq, f.p_seq,
               (NOT m.empty AND ((m.kind = 'news' AND f.p_seq IS NOT NULL)
                                 OR (m.kind = 'prices' AND f.n_seq IS NOT NULL))) AS emit
        FROM fold f JOIN msgs m ON m.symbol = f.symbol AND m.rn = f.rn + 1) s),
pairs AS (
  SELECT f.symbol, f.e_seq AS pseq, f.e_news, pm.day AS day
  FROM fold f JOIN pm ON pm.symbol = f.symbol AND pm.seq = f.e_prices
  WHERE f.e_seq IS NOT NULL),
news AS (
  SELECT {news_cols}
  FROM ev JOIN pairs p ON ev.symbol = p.symbol AND floor(ev.event_id / {block}) = floor(p.e_news / {block})
  WHERE ev.event_type IN ('view', 'click', 'signup')),
bars AS (
  SELECT p.symbol || '#' || CAST(p.pseq AS VARCHAR) AS symbol, b.date, b.open, b.high, b.low, b.close,
         b.adjusted_close, b.volume, b.dividend_amount, b.split_coefficient
  FROM bars0 b JOIN pairs p ON b.symbol = p.symbol AND b.date < p.day AND b.date >= p.day - {history}),
{DAILY},
{predicted(as_of)},
inner_rows AS (
  SELECT p.symbol AS pkey, p.date AS date, p.close AS close_price, p.prediction AS close_price_prediction,
         d.positive_news_amount, d.negative_news_amount, d.ticker_sentiment_score_mean,
         d.ticker_sentiment_score_mean_label, d.overall_sentiment_score_mean, d.overall_sentiment_score_mean_label
  FROM pred p JOIN daily_l d ON p.symbol = d.symbol AND p.date = d.date),
quotes AS (SELECT symbol, arg_max(close, date) AS current_price FROM bars0 GROUP BY symbol),
comb AS (
  SELECT split_part(i.pkey, '#', 1) AS symbol, i.* EXCLUDE (pkey),
         '{now}' AS timestamp, q.current_price AS current_price
  FROM inner_rows i LEFT JOIN quotes q ON split_part(i.pkey, '#', 1) = q.symbol)
{documents_select('comb')}"""


def late_articles(daily: str, items: int) -> str:
    """Daily sentiment with the articles in time and late, where the articles
    come in three portions of document blocks and a day's watermark."""
    return (
        with_(EV, EV_NEWS, f"""part AS (
  SELECT *, (event_id // {items}) % 3 AS portion FROM news),
marks AS (
  SELECT p.portion, (SELECT max(time_published) FROM part e WHERE e.portion < p.portion) AS latest
  FROM (SELECT DISTINCT portion FROM part) p),
split AS (
  SELECT ticker, CAST(time_published AS DATE) AS day,
         coalesce(CAST(time_published AS DATE) + INTERVAL 1 DAY <= latest - INTERVAL 1 DAY, false) AS is_late
  FROM part JOIN marks USING (portion))""")
        + f"""SELECT d.*, c.in_time, c.late
FROM ({daily}) d JOIN (
  SELECT ticker, {iso_date('day')} AS day, count(*) FILTER (NOT is_late) AS in_time, count(*) FILTER (is_late) AS late
  FROM split GROUP BY ALL) c ON d.symbol = c.ticker AND d.date = c.day"""
    )
