"""Next-day close: label (W1), split (P10/P11/M2), one least-squares model per
symbol (M1/M3), scoring (M4) and the calendar-shifted right join (F4/J1).

Design for many symbols at once:

* The label and everything the shifted join needs come from ONE window pass
  (partition by symbol, order by date): the row at ``date + 1`` is the next
  row when it exists, because dates are unique per symbol. So the right join
  of the reference becomes ``lead`` values plus an equality test, with no
  join and no extra shuffle.
* The fit is an aggregate: per symbol, the means and the population
  co-moments of the features and the label (Spark's ``covar_pop`` merges
  partial states map-side, so a hot symbol costs nothing extra). Only those
  k(k+3)/2 + k + 2 numbers per symbol reach Python, where a batched
  pseudo-inverse solves the standardised k×k system. No rows are collected.
* Scoring is a join of the small coefficient frame on ``symbol`` and a
  linear expression, all JVM-side.

Semantics kept from the reference: the label is the next row's close within
the symbol (default NULL); training rows are ``date < as_of`` with no NULL or
NaN in any column; scored rows are ``date <= as_of`` (a superset, so fitted
values are in-sample); a feature that is constant over the training rows gets
coefficient 0; the prediction moves one calendar day forward, so the first
price date, Mondays and post-holiday dates get no prediction and weekend
dates appear with NULL prices. A NULL feature scores to NULL instead of
failing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickcast.schemas import FEATURES, PRICE_MEASURES
from tickcast.sources.sinks import write_batch

LABEL = "next_day_close"
_NEXT = "_nx_"


def as_of_date(as_of: str | Column | None = None) -> Column:
    """The split date; default is yesterday, as in the reference."""
    if as_of is None:
        return F.date_sub(F.current_date(), 1)
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    return F.to_date(F.lit(as_of))


def with_next_rows(prices: DataFrame) -> DataFrame:
    """W1 plus the next row's values, in one window pass per symbol.

    Adds ``next_day_close`` = lead(close) and hidden ``_nx_*`` columns (the
    next row's date, measures and label) used by :func:`shift_right_join`.
    The lead expressions share one window specification, so they run in a
    single Window operator after one exchange by symbol.
    """
    p = prices.select("symbol", F.to_date("date").alias("date"), *PRICE_MEASURES)
    over = "OVER (PARTITION BY symbol ORDER BY date)"
    leads = [f"lead(close, 1) {over} AS {LABEL}", f"lead(date, 1) {over} AS {_NEXT}date"]
    leads += [f"lead({m}, 1) {over} AS {_NEXT}{m}" for m in PRICE_MEASURES]
    leads += [f"lead(close, 2) {over} AS {_NEXT}{LABEL}"]
    return p.selectExpr("*", *leads)


def next_day_close(prices: DataFrame) -> DataFrame:
    """W1 alone: prices plus ``next_day_close``."""
    return with_next_rows(prices).select("symbol", "date", *PRICE_MEASURES, LABEL)


def training_condition(labelled: DataFrame, as_of: str | Column | None = None) -> Column:
    """P10 + P11: ``date < as_of`` and no NULL/NaN in any visible column
    (a NULL adjusted close removes a row too, as ``na.drop()`` does)."""
    checks = []
    for c, t in labelled.dtypes:
        if c.startswith(_NEXT):
            continue
        checks.append(f"`{c}` IS NOT NULL")
        if t in ("double", "float"):
            checks.append(f"NOT isnan(`{c}`)")
    return (F.col("date") < as_of_date(as_of)) & F.expr(" AND ".join(checks))


def training_rows(labelled: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    return labelled.filter(training_condition(labelled, as_of))


def scoring_rows(labelled: DataFrame, as_of: str | Column | None = None) -> DataFrame:
    """P10: ``date <= as_of``."""
    return labelled.filter(F.col("date") <= as_of_date(as_of))


def _pair(i: int, j: int) -> str:
    return f"_c_{i}_{j}"


def moments(train: DataFrame, features: list[str], label: str = LABEL) -> DataFrame:
    """Per-symbol sufficient statistics of an OLS fit: count, means and
    population co-moments. One hash aggregate with map-side partials."""
    k = len(features)
    aggs = ["count(1) AS n_train", f"avg(`{label}`) AS _my"]
    aggs += [f"avg(`{f}`) AS _mx_{i}" for i, f in enumerate(features)]
    aggs += [f"covar_pop(`{features[i]}`, `{features[j]}`) AS {_pair(i, j)}" for i in range(k) for j in range(i, k)]
    aggs += [f"covar_pop(`{features[i]}`, `{label}`) AS {_pair(i, k)}" for i in range(k)]
    return train.groupBy("symbol").agg(*[F.expr(a) for a in aggs])


def coefficient_schema(features: list[str]) -> T.StructType:
    return T.StructType(
        [
            T.StructField("symbol", T.StringType()),
            T.StructField("n_train", T.LongType()),
            T.StructField("intercept", T.DoubleType()),
        ]
        + [T.StructField(f"b_{f}", T.DoubleType()) for f in features]
    )


def solve_moments(pdf: pd.DataFrame, k: int, rel_tol: float = 1e-12) -> np.ndarray:
    """Batched OLS solve from moments. Returns an (n, k+1) array of
    [intercept, b_1..b_k]. Features with zero variance get 0; a singular
    standardised system gets the minimum-norm solution."""
    n = len(pdf)
    cov = np.zeros((n, k, k))
    for i in range(k):
        for j in range(i, k):
            v = pdf[_pair(i, j)].to_numpy(dtype=float)
            cov[:, i, j] = v
            cov[:, j, i] = v
    cxy = np.stack([pdf[_pair(i, k)].to_numpy(dtype=float) for i in range(k)], axis=1)
    mx = np.stack([pdf[f"_mx_{i}"].to_numpy(dtype=float) for i in range(k)], axis=1)
    my = pdf["_my"].to_numpy(dtype=float)
    var = np.clip(np.diagonal(cov, axis1=1, axis2=2), 0.0, None)
    sd = np.sqrt(var)
    active = sd > rel_tol * np.maximum(np.abs(mx), 1e-300)
    safe = np.where(active, sd, 1.0)
    corr = cov / (safe[:, :, None] * safe[:, None, :])
    mask = active[:, :, None] & active[:, None, :]
    corr = np.where(mask, corr, 0.0)
    rhs = np.where(active, cxy / safe, 0.0)
    beta_std = np.einsum("nij,nj->ni", np.linalg.pinv(corr), rhs)
    beta = np.where(active, beta_std / safe, 0.0)
    intercept = my - np.einsum("ni,ni->n", beta, mx)
    return np.column_stack([intercept, beta])


def solved(stats: DataFrame, features: list[str]) -> DataFrame:
    """(symbol, n_train, intercept, b_<feature>...) from moments."""
    k = len(features)

    def solve(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            coef = solve_moments(pdf, k)
            out = pd.DataFrame({"symbol": pdf["symbol"], "n_train": pdf["n_train"].astype("int64")})
            out["intercept"] = coef[:, 0]
            for i, f in enumerate(features):
                out[f"b_{f}"] = coef[:, i + 1]
            yield out

    return stats.mapInPandas(solve, coefficient_schema(features))


def fit_next_close(
    labelled: DataFrame,
    as_of: str | Column | None = None,
    features: list[str] | None = None,
    label: str = LABEL,
) -> DataFrame:
    """M3: one least-squares model per symbol → (symbol, n_train, intercept,
    b_<feature>...). Runs as an aggregate plus an Arrow batch solve over the
    aggregated rows only (one row per symbol)."""
    features = list(features or FEATURES)
    return solved(moments(training_rows(labelled, as_of), features, label), features)


def merged_moments(parts: DataFrame, features: list[str]) -> DataFrame:
    """The moments of several row sets as one per symbol: counts add, means are
    weighted, and a co-moment gains the product of the shifts of its means."""
    k = len(features)
    n = "CAST(n_train AS double)"
    means = [f"sum({n} * `{c}`) / sum({n}) AS _t{c}" for c in ["_my", *(f"_mx_{i}" for i in range(k))]]
    total = parts.groupBy(F.col("symbol").alias("_s")).agg(*[F.expr(m) for m in means])
    both = parts.join(total, F.col("symbol").eqNullSafe(F.col("_s")))

    def gap(i: int) -> str:
        c = "_my" if i == k else f"_mx_{i}"
        return f"(`{c}` - `_t{c}`)"

    pairs = [(i, j) for i in range(k) for j in range(i, k + 1)]
    aggs = ["sum(n_train) AS n_train", "first(_t_my) AS _my", *(f"first(_t_mx_{i}) AS _mx_{i}" for i in range(k))]
    aggs += [f"sum({n} * (`{_pair(i, j)}` + {gap(i)} * {gap(j)})) / sum({n}) AS `{_pair(i, j)}`" for i, j in pairs]
    return both.groupBy("symbol").agg(*[F.expr(a) for a in aggs])


def update_fit(
    spark: SparkSession,
    path: str,
    bars: DataFrame,
    batch_id: int,
    as_of: str | Column | None = None,
    features: list[str] | None = None,
) -> DataFrame:
    """M3 on growing prices: add the ``bars`` of new days (each after the
    symbol's days of earlier batches) and give the coefficients as a refit of
    all history would.

    ``path`` keeps one row of moments per symbol and batch, and the open bars:
    those without a next day yet (their label comes with the next batch) and
    those not before ``as_of``. A batch reads these two and its own bars, never
    the history. Both are written per batch id, so a repeated batch replaces
    itself; ``as_of`` must not go back. Batch ids rise from 0."""
    features = list(features or FEATURES)
    columns = ["symbol", "date", *PRICE_MEASURES]
    own = bars.select("symbol", F.to_date("date").alias("date"), *PRICE_MEASURES)
    batch = T.StructField("_batch", T.LongType())
    if batch_id:
        schema = T.StructType([*own.schema.fields, batch])
        last = spark.read.schema(schema).parquet(f"{path}/open").filter(F.col("_batch") == batch_id - 1)
        own = last.select(*columns).unionByName(own)
    labelled = with_next_rows(own)
    ready = labelled.filter(F.col(f"{_NEXT}date").isNotNull() & (F.col("date") < as_of_date(as_of)))
    write_batch(labelled.filter(F.col(f"{_NEXT}date").isNull() | (F.col("date") >= as_of_date(as_of))).select(*columns), f"{path}/open", batch_id)
    fresh = moments(training_rows(ready, as_of), features)
    write_batch(fresh, f"{path}/moments", batch_id)
    parts = spark.read.schema(T.StructType([*fresh.schema.fields, batch])).parquet(f"{path}/moments").filter(F.col("_batch") <= batch_id)
    return solved(merged_moments(parts.drop("_batch"), features), features)


def score(rows: DataFrame, coefficients: DataFrame, features: list[str] | None = None) -> DataFrame:
    """M4: ``prediction = intercept + Σ b_f · f`` (NULL if a feature is NULL
    or the symbol has no model)."""
    features = list(features or FEATURES)
    joined = rows.join(coefficients.drop("n_train"), "symbol", "left")
    pred = " + ".join(["intercept"] + [f"`b_{f}` * `{f}`" for f in features])
    return joined.select(*rows.columns, F.expr(pred).alias("prediction"))


def shift_right_join(scored: DataFrame, shift: str = "calendar") -> DataFrame:
    """F4 + J1: move each scored row's prediction to the next day and attach
    the price row of that day, as the right outer join on date does.

    ``calendar`` (faithful): target = date + 1 day; prices attach only when
    the next price row is exactly that day. ``trading``: target = the next
    price date (date + 1 day after the last one), so no prediction is lost
    over weekends.
    """
    nx_date = F.col(f"{_NEXT}date")
    if shift == "calendar":
        target = F.date_add("date", 1)
        matched = nx_date.isNotNull() & (nx_date == target)
    elif shift == "trading":
        target = F.coalesce(nx_date, F.date_add("date", 1))
        matched = nx_date.isNotNull()
    else:
        raise ValueError(f"shift must be 'calendar' or 'trading', not {shift!r}")

    def attached(c: str) -> Column:
        return F.when(matched, F.col(f"{_NEXT}{c}"))

    return scored.select(
        "symbol",
        target.alias("date"),
        *[attached(m).alias(m) for m in PRICE_MEASURES],
        attached(LABEL).alias(LABEL),
        "prediction",
    )


def predict_next_close(
    prices: DataFrame,
    as_of: str | Column | None = None,
    features: list[str] | None = None,
    shift: str = "calendar",
    persist: bool = True,
    dedup_by: str | None = None,
) -> DataFrame:
    """Prices → (symbol, date, 8 measures, next_day_close,
    prediction), one row per scored day, dated the next day.

    The labelled bars feed both the fit and the scoring; they are daily
    aggregates (one row per symbol and day), so they are persisted once
    (memory, spilling to disk; recomputed from lineage if an executor is
    lost) instead of recomputing the upstream joins twice.

    ``dedup_by`` names a document-order column: overlapping documents repeat
    days, and only the latest document's row per (symbol, date) is kept
    before the window (otherwise ``lead`` would be ambiguous)."""
    features = list(features or FEATURES)
    if dedup_by:
        from tickcast.operators.formatting import latest_bars

        prices = latest_bars(prices.withColumn("date", F.to_date("date")), dedup_by)
    labelled = with_next_rows(prices)
    if persist:
        labelled = labelled.persist(StorageLevel.MEMORY_AND_DISK)
    coefficients = fit_next_close(labelled, as_of, features)
    scored = score(scoring_rows(labelled, as_of), coefficients, features)
    return shift_right_join(scored, shift)
