"""Model features and splits (declared by the reference, defined here).

Every window is partitioned by ticker and ordered by date; a ticker holds one row per
trading day, so frames stay small. Features look only backwards (``rowsBetween(-k, 0)``,
``lag``); targets look only forwards (``lead``) — no look-ahead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Our definitions (the reference declares these features without code).
SHORT_WINDOW, LONG_WINDOW = 3, 7
VOL_WINDOW = 5
SPIKE_WINDOW, SPIKE_RATIO = 20, 2.0
HORIZON = 5
TEST_SIZE, VALID_SIZE = 0.2, 0.25
SIGNAL_THRESHOLD = 0.05


def _w(by: str, order: str) -> Window:
    return Window.partitionBy(by).orderBy(order)


def sentiment_momentum(df: DataFrame, score: str = "sentiment_score", by: str = "symbol",
                       order: str = "date", short: int = SHORT_WINDOW,
                       long: int = LONG_WINDOW) -> DataFrame:
    """Short minus long trailing mean of the daily sentiment score."""
    w = _w(by, order)
    return df.withColumn(
        "sentiment_momentum",
        F.avg(score).over(w.rowsBetween(-(short - 1), 0)) -
        F.avg(score).over(w.rowsBetween(-(long - 1), 0)))


def lagged_volatility(df: DataFrame, ret: str = "daily_return", high: str = "high",
                      low: str = "low", by: str = "symbol", order: str = "date",
                      window: int = VOL_WINDOW, lags: Sequence[int] = (1,)) -> DataFrame:
    """Past-only volatility: the sample std of returns over the previous ``window`` bars
    (excluding today) and lagged bar ranges."""
    w = _w(by, order)
    out = df.withColumn("volatility_lag1",
                        F.stddev_samp(ret).over(w.rowsBetween(-window, -1)))
    for k in lags:
        out = out.withColumn(f"range_lag{k}", F.lag(F.col(high) - F.col(low), k).over(w))
    return out


def volume_spike(df: DataFrame, volume: str = "volume", by: str = "symbol",
                 order: str = "date", window: int = SPIKE_WINDOW,
                 ratio: float = SPIKE_RATIO) -> DataFrame:
    """Volume relative to the trailing mean of the previous ``window`` bars, and a flag
    above ``ratio``."""
    w = _w(by, order)
    rel = F.try_divide(F.col(volume).cast("double"),
                       F.avg(volume).over(w.rowsBetween(-window, -1)))
    return df.withColumns({"volume_ratio": rel,
                           "volume_spike": F.coalesce(rel > ratio, F.lit(False))})


def forward_target(df: DataFrame, close: str = "close", by: str = "symbol",
                   order: str = "date", h: int = HORIZON) -> DataFrame:
    """Return ``h`` bars ahead: ``close[t+h] / close[t] - 1`` (future only)."""
    w = _w(by, order)
    return df.withColumn(f"target_return_{h}",
                         F.try_divide(F.lead(close, h).over(w), F.col(close)) - 1)


def feature_table(bars: DataFrame, sentiment: DataFrame, by: str = "symbol",
                  order: str = "date") -> DataFrame:
    """Per (ticker, date): daily return, past volatility, volume spike, sentiment
    momentum and the forward target. Bars and sentiment are each windowed per ticker,
    then joined on (ticker, date) — both sides are per-day aggregates."""
    w = _w(by, order)
    b = bars.withColumn("daily_return",
                        F.try_divide(F.col("close"), F.lag("close").over(w)) - 1)
    b = forward_target(volume_spike(lagged_volatility(b)))
    s = sentiment_momentum(sentiment.select(by, order, "sentiment_score"))
    return b.join(s, [by, order], "left")


def time_split(df: DataFrame, by: str = "symbol", order: str = "date",
               test_size: float = TEST_SIZE, valid_size: float = VALID_SIZE) -> DataFrame:
    """Chronological split per ticker: the last ``ceil(test_size·n)`` rows are test, the
    last ``ceil(valid_size·rest)`` of the rest are validation, the others train."""
    w = _w(by, order)
    n = F.count(F.lit(1)).over(Window.partitionBy(by))
    rn = F.row_number().over(w)
    out = df.withColumns({"_n": n, "_rn": rn})
    n_test = F.ceil(F.col("_n") * F.lit(test_size))
    rest = F.col("_n") - n_test
    n_train = rest - F.ceil(rest * F.lit(valid_size))
    split = (F.when(F.col("_rn") <= n_train, F.lit("train"))
              .when(F.col("_rn") <= rest, F.lit("valid")).otherwise(F.lit("test")))
    return out.withColumn("split", split).drop("_n", "_rn")


def scale_features(df: DataFrame, cols: Sequence[str], fit_on: str = "train",
                   split_col: str = "split", method: str = "standard") -> DataFrame:
    """Standard (``(x - mean) / std_samp``) or min-max scaling with statistics fitted
    on the ``fit_on`` split only. The statistics are one global aggregate, applied as a
    scalar subquery (no join, no broadcast of data)."""
    fit = df.where(F.col(split_col) == fit_on)
    if method == "standard":
        stats = fit.select(F.struct(*[F.struct(F.avg(c).alias("a"), F.stddev_samp(c).alias("b"))
                                      .alias(c) for c in cols]).alias("s"))
    else:
        stats = fit.select(F.struct(*[F.struct(F.min(c).alias("a"),
                                               (F.max(c) - F.min(c)).alias("b")).alias(c)
                                      for c in cols]).alias("s"))
    st = stats.scalar()
    return df.withColumns({f"{c}_scaled": F.try_divide(F.col(c) - st[c]["a"], st[c]["b"])
                           for c in cols})


def trading_signal(df: DataFrame, momentum: str = "sentiment_momentum",
                   spike: str = "volume_spike", threshold: float = SIGNAL_THRESHOLD
                   ) -> DataFrame:
    """up / down when sentiment momentum beyond ±threshold coincides with a volume
    spike, else none."""
    m, s = F.col(momentum), F.coalesce(F.col(spike), F.lit(False))
    return df.withColumn("signal", F.when((m > threshold) & s, F.lit("up"))
                                    .when((m < -threshold) & s, F.lit("down"))
                                    .otherwise(F.lit("none")))
