"""Dashboard analytics: sentiment/price join, correlation and trend, event phases,
forecast summaries, model metrics and the reshapes the dashboard pages use.

Every function is ``DataFrame -> DataFrame``; multi-symbol forms group by ``symbol`` so
one job answers the question for every symbol at once (the reference asks one symbol at
a time).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketweave.functions.formatting import fixed, fixed2
from marketweave.functions.stats import corr_strength, safe_corr


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- J01 / A04-A06 / U05

def sentiment_price_join(prices: DataFrame, sentiment: DataFrame,
                         keys: Sequence[str] = ("symbol", "date"),
                         price_col: str = "price", score_col: str = "sentiment_score") -> DataFrame:
    """Inner equi-join of a price series and a sentiment series, then drop rows with a
    null price or score. Both inputs carry ``volume``; it comes out as ``price_volume``
    and ``sentiment_volume``. Null join keys never match (pandas would match them).

    Both sides are per-(symbol, day) aggregates; the join shuffles on the keys (or is
    broadcast by AQE when one side is measured small).
    """
    keys = list(keys)
    p = prices.select(*keys, _c(price_col).alias("price"),
                      F.col("volume").alias("price_volume"))
    s = sentiment.select(*keys, _c(score_col).alias("sentiment_score"),
                         F.col("volume").alias("sentiment_volume"))
    return (p.join(s, keys, "inner")
             .where(F.col("price").isNotNull() & F.col("sentiment_score").isNotNull()))


def correlation_report(df: DataFrame, x: str = "sentiment_score", y: str = "price",
                       by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per group: n, Pearson r (null for zero variance), its strength label and the OLS
    line ``y = slope * x + intercept`` with R². One partial-aggregated pass."""
    g = df.groupBy(*by) if by else df.groupBy()
    r = g.agg(F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"),
              safe_corr(x, y).alias("correlation"),
              F.regr_slope(y, x).alias("slope"),
              F.regr_intercept(y, x).alias("intercept"),
              F.regr_r2(y, x).alias("r2"))
    return r.withColumn("strength", corr_strength("correlation"))


def pearson_corr(df: DataFrame, x: str = "sentiment_score", y: str = "price",
                 by: Sequence[str] = ("symbol",)) -> DataFrame:
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(safe_corr(x, y).alias("correlation"))


def ols_trend(df: DataFrame, x: str = "sentiment_score", y: str = "price",
              by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Least-squares trend line of ``y`` on ``x``; constant ``x`` gives null slope."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"),
                 F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def dual_series(df: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """date, price, sentiment_score ordered by date — the two-axis plot's data, with the
    position of each row in its group (``row_number``)."""
    at = F.row_number().over(Window.partitionBy(*by).orderBy("date"))
    return df.select(*by, "date", "price", "sentiment_score", at.alias("row_number")) \
        .orderBy(*by, "date")


# ---------------------------------------------------------------- W03 / A02 / A03

def event_phase(df: DataFrame, by: str = "symbol", order_by: str = "date",
                before: int = 10, during: int = 10) -> DataFrame:
    """Ordinal phase by position inside each group: the first ``before`` rows are
    ``Before``, the next ``during`` rows ``During``, the rest ``After``."""
    w = Window.partitionBy(by).orderBy(order_by)
    rn = F.row_number().over(w)
    return df.withColumn("phase", F.when(rn <= before, F.lit("Before"))
                                   .when(rn <= before + during, F.lit("During"))
                                   .otherwise(F.lit("After")))


def phase_averages(df: DataFrame, value: str = "price", by: Sequence[str] = ("symbol",)
                   ) -> DataFrame:
    """mean(value) for each of Before / During / After, one row per group."""
    v, ph = F.col(value), F.col("phase")
    return df.groupBy(*by).agg(F.avg(F.when(ph == "Before", v)).alias("before_avg"),
                               F.avg(F.when(ph == "During", v)).alias("during_avg"),
                               F.avg(F.when(ph == "After", v)).alias("after_avg"))


def event_impact(avgs: DataFrame) -> DataFrame:
    """Changes between phases and their labels; strict ``>`` (ties take the 2nd label)."""
    b, d, a = F.col("before_avg"), F.col("during_avg"), F.col("after_avg")
    return avgs.select(
        "*",
        (d - b).alias("during_change"), (a - d).alias("after_change"),
        F.abs(d - b).alias("during_change_abs"), F.abs(a - d).alias("after_change_abs"),
        # The impact label texts.
        F.when(d > b, F.lit("increased")).otherwise(F.lit("decreased")).alias("during_label"),
        F.when(a > d, F.lit("continued to increase")).otherwise(F.lit("began to decrease"))
         .alias("after_label"),
        F.when(a > b, F.lit("Positive")).otherwise(F.lit("Negative")).alias("overall_impact"))


# ---------------------------------------------------------------- A07 / A08 / forecasts

def overall_change(df: DataFrame, price: str = "predicted_price", order_by: str = "date",
                   by: Sequence[str] = ("symbol",)) -> DataFrame:
    """last - first price (by ``order_by``) and the change in % of the first."""
    first = F.min_by(price, order_by)
    last = F.max_by(price, order_by)
    return (df.groupBy(*by).agg(first.alias("first_price"), last.alias("last_price"))
              .withColumn("overall_change", F.col("last_price") - F.col("first_price"))
              .withColumn("overall_change_pct",
                          F.try_divide(F.col("overall_change"), F.col("first_price")) * 100))


def date_extent(df: DataFrame, col: str = "date", by: Sequence[str] = ("symbol",)) -> DataFrame:
    return df.groupBy(*by).agg(F.min(col).alias("first_date"), F.max(col).alias("last_date"))


def explode_predictions(df: DataFrame, keep: Sequence[str] = ("ticker", "model_used")
                        ) -> DataFrame:
    """``predictions map<date text, struct<predicted_return, predicted_price>>`` → rows."""
    e = df.select(*keep, F.explode("predictions").alias("prediction_date", "p"))
    return e.select(*keep, F.to_date("prediction_date").alias("date"),
                    F.col("p.predicted_return").alias("predicted_return"),
                    F.col("p.predicted_price").alias("predicted_price"))


# ---------------------------------------------------------------- A09-A12, P25, U03, U04

def _err(actual: str, predicted: str) -> Column:
    return F.col(predicted) - F.col(actual)


def direction_hit(actual_ret: str = "actual_return", pred_ret: str = "predicted_return"
                  ) -> Column:
    return (F.signum(actual_ret) == F.signum(pred_ret)).cast("int")


def regression_metrics(df: DataFrame, by: Sequence[str] = ("symbol",),
                       actual: str = "actual_price", predicted: str = "predicted_price",
                       actual_ret: str = "actual_return", pred_ret: str = "predicted_return"
                       ) -> DataFrame:
    """RMSE, MAE, R² and directional accuracy, per group (``by=()`` for overall).

    R² = 1 - SSE / (n * var_pop(actual)); null when the actual values are constant.
    """
    e = _err(actual, predicted)
    both = F.col(actual).isNotNull() & F.col(predicted).isNotNull()
    ee = F.when(both, e)
    aa = F.when(both, F.col(actual))
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(
        F.count(ee).alias("n"),
        F.sqrt(F.avg(ee * ee)).alias("rmse"),
        F.avg(F.abs(ee)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(ee * ee), F.var_pop(aa) * F.count(ee))).alias("r2"),
        F.avg(direction_hit(actual_ret, pred_ret)).alias("accuracy"))


def confusion_matrix(df: DataFrame, actual_ret: str = "actual_return",
                     pred_ret: str = "predicted_return") -> DataFrame:
    """2x2 counts: rows Actual Up / Actual Down, columns Predicted Up / Predicted Down, always
    both rows. A return > 0 is Up, otherwise Down (zero goes to Down, as the reference
    formats)."""
    both = F.col(actual_ret).isNotNull() & F.col(pred_ret).isNotNull()
    up, said = F.col(actual_ret) > 0, F.col(pred_ret) > 0
    n = df.where(both).agg(*[F.count_if(c).alias(name) for name, c in (
        ("uu", up & said), ("ud", up & ~said), ("du", ~up & said), ("dd", ~up & ~said))])
    row = lambda label, a, b: F.struct(F.lit(label).alias("actual"),
                                       F.col(a).alias("predicted_up"), F.col(b).alias("predicted_down"))
    return n.select(F.inline(F.array(row("Actual Up", "uu", "ud"), row("Actual Down", "du", "dd"))))


def best_symbol(metrics: DataFrame, by: str = "symbol", score: str = "accuracy") -> DataFrame:
    """The group with the highest ``score`` and its RMSE; ties go to the first ``by`` in
    name order (the reference takes the first in its fixed symbol list). Planned as a
    top-1 ``TakeOrderedAndProject`` (per-task top-1, then a merge)."""
    ranked = metrics.select(by, "rmse", score)
    return (ranked.orderBy(F.desc_nulls_last(score), F.asc(by)).limit(1))


def clamp(x: str | Column, lo: float | None = 0.0, hi: float | None = None) -> Column:
    """``max(lo, x)`` / ``min(hi, max(lo, x))``; null stays null (greatest/least would
    skip it)."""
    c = _c(x)
    out = c
    if lo is not None:
        out = F.greatest(F.lit(lo), out)
    if hi is not None:
        out = F.least(F.lit(hi), out)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(out)


def metric_history(df: DataFrame, date: str = "date", actual: str = "actual_price",
                   predicted: str = "predicted_price") -> DataFrame:
    """Per day: RMSE (clamped at 0) and directional accuracy (clamped to [0, 1])."""
    e = _err(actual, predicted)
    g = df.groupBy(date).agg(F.sqrt(F.avg(e * e)).alias("_rmse"),
                             F.avg(direction_hit()).alias("_acc"))
    return g.select(date, clamp("_rmse", 0.0).alias("rmse"),
                    clamp("_acc", 0.0, 1.0).alias("accuracy"))


def metrics_long(wide: DataFrame, id_col: str = "symbol",
                 metrics: Sequence[str] = ("rmse", "mae", "r2", "accuracy")) -> DataFrame:
    """Wide metric table → (id, metric, value) rows."""
    return wide.select(id_col, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        [id_col], list(metrics), "metric", "value")


# ---------------------------------------------------------------- S06-S08, S11

def find_documents(df: DataFrame, query: dict | None = None,
                   projection: Sequence[str] | None = None,
                   sort: Sequence[tuple[str, int]] | None = None,
                   limit: int | None = None) -> DataFrame:
    """Equality filter (``None`` matches null, as a document store matches null or
    missing), optional projection, multi-key sort (1 asc / -1 desc) and limit. Sort +
    limit plans as ``TakeOrderedAndProject`` (per-task top-n, then a merge)."""
    out = df
    for k, v in (query or {}).items():
        out = out.where(F.col(k).eqNullSafe(F.lit(v)))
    if sort:
        out = out.orderBy(*[F.asc(c) if d >= 0 else F.desc(c) for c, d in sort])
    if limit:
        out = out.limit(limit)
    if projection:
        out = out.select(*projection)
    return out


def last_n_by_symbol(df: DataFrame, n: int = 30, by: str = "symbol", order_by: str = "date",
                     tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest ``n`` rows of every symbol (a row limit, not a date range). Spark plans
    the rank filter as a per-partition WindowGroupLimit before the shuffle."""
    w = Window.partitionBy(by).orderBy(F.desc(order_by), *[F.desc(t) for t in tiebreak])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def bounded_history(df: DataFrame, days: int, date: str = "date",
                    by: Sequence[str] = ()) -> DataFrame:
    """Rows within ``days`` days of the latest date (per group or overall). The latest
    date comes from a one-row (or per-group) aggregate joined back; no ``now()``."""
    if by:
        mx = df.groupBy(*by).agg(F.max(date).alias("_max"))
        j = df.join(mx, list(by))
        return j.where(F.col(date) > F.date_sub(F.col("_max"), days)).drop("_max")
    # one scalar subquery: the latest date, evaluated once
    latest = df.select(F.max(date)).scalar()
    return df.where(F.col(date) > F.date_sub(latest, days))


def year_range(df: DataFrame, lo: int, hi: int, year_col: str = "year") -> DataFrame:
    return df.where(F.col(year_col).between(lo, hi))


def calendar_spine(starts: DataFrame, days: int, by: str = "symbol", start: str = "start",
                   noise_seed: int | None = None) -> DataFrame:
    """Daily dates ``start .. start + days - 1`` per group with a deterministic trend
    value ``100 + i`` (the dashboard's fallback series); ``noise_seed`` adds standard
    normal noise (opt-in, seeded)."""
    s = starts.select(by, F.posexplode(F.sequence(F.col(start),
                                                  F.date_add(F.col(start), days - 1)))
                      .alias("i", "date"))
    trend = F.lit(100.0) + F.col("i")
    if noise_seed is not None:
        trend = trend + F.randn(noise_seed)
    return s.select(by, "date", trend.alias("trend"))


# ---------------------------------------------------------------- P24 / P27 / U01-U02

def format_metrics(df: DataFrame, price: str = "predicted_price",
                   ret: str = "predicted_return") -> DataFrame:
    """Display texts: ``$1234.56``, signed percent change ``+1.23%`` and an up/down
    marker (zero counts as down, as in the reference)."""
    return df.withColumns({
        "price_text": fixed2(price, prefix="$"),
        "change_text": fixed2(F.col(ret) * 100, suffix="%", signed=True),
        "direction": F.when(F.col(ret) > 0, F.lit("up")).otherwise(F.lit("down"))})


# The up / down markers of a formatted prediction.
UP_MARK, DOWN_MARK = "📈", "📉"


def prediction_text(value: str | Column, confidence: str | Column) -> Column:
    """``📈 +1.23 (85.0% confidence)`` for a positive value, ``📉 -0.45 (...)`` otherwise
    (zero counts as down)."""
    v = F.col(value) if isinstance(value, str) else value
    c = F.col(confidence) if isinstance(confidence, str) else confidence
    conf = F.concat(F.lit(" ("), fixed(c * 100, 1), F.lit("% confidence)"))
    return (F.when(v > 0, F.concat(F.lit(UP_MARK + " "), fixed(v, 2, signed=True), conf))
             .otherwise(F.concat(F.lit(DOWN_MARK + " "), fixed(v, 2), conf)))


def rename_display(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns to display names."""
    return df.withColumnsRenamed(names)


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; columns missing on one side become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
