"""Price-bar cleaning: flatten, drop incomplete bars, IQR outlier fences with forward
fill, daily returns, calendar features.

Bars are one row per (ticker, day): per-ticker windows hold at most one row per trading
day, so they stay small however large the raw data grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketweave.operators.quantiles import quantile_arrays
from marketweave.session import stored

PRICE_COLS = ("open", "high", "low", "close")
ESSENTIAL_COLS = ("open", "high", "low", "close", "volume")
FENCE_K = 3.0  # fixed value: fences at Q1 - 3*IQR and Q3 + 3*IQR


def flatten_ticker_map(raw: DataFrame, col: str = "value", bar_schema: str | None = None
                       ) -> DataFrame:
    """``{ticker: [bar, ...]}`` JSON text (or an already typed map column) → one row per
    bar with a ``ticker`` column. ``bar_schema`` is the struct DDL of one bar."""
    c = F.col(col)
    if bar_schema is not None:
        c = F.from_json(c, f"map<string, array<struct<{bar_schema}>>>")
    e = raw.select(F.explode(c).alias("ticker", "_bars"))
    return e.select("ticker", F.inline("_bars"))


def flatten_colnames(df: DataFrame) -> DataFrame:
    """Multi-level column names → their first level: a struct column holding a single
    second-level field (e.g. ``Close.{ticker}`` of a one-ticker download) becomes a plain
    column named after the first level; map keys are rendered as text."""
    out = []
    for f in df.schema.fields:
        dt = f.dataType
        if dt.typeName() == "struct" and len(dt.fields) == 1:
            out.append(F.col(f"`{f.name}`.`{dt.fields[0].name}`").alias(f.name))
        elif dt.typeName() == "map":
            out.append(F.transform_keys(F.col(f"`{f.name}`"), lambda k, _v: k.cast("string"))
                        .alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def bar_range(df: DataFrame, high: str = "high", low: str = "low") -> DataFrame:
    """``volatility = high - low`` per bar."""
    return df.withColumn("volatility", F.col(high) - F.col(low))


def drop_incomplete_bars(df: DataFrame, cols: Sequence[str] = ESSENTIAL_COLS) -> DataFrame:
    """Drop bars with a null in any present essential column (a null date is kept)."""
    present = [c for c in cols if c in df.columns]
    return df.na.drop(subset=present) if present else df


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Day-of-week and month names (English) and the year."""
    return df.withColumns({"day_of_week": F.date_format(date, "EEEE"),
                           "month": F.date_format(date, "MMMM"),
                           "year": F.year(date)})


def iqr_bounds(df: DataFrame, cols: Sequence[str] = PRICE_COLS, by: Sequence[str] = (),
               k: float = FENCE_K, is_stored: bool = False) -> DataFrame:
    """Q1, Q3 (linear interpolation), IQR and fences ``Q1 - k*IQR``, ``Q3 + k*IQR`` of each
    column: one row per (group, column). Exact values with bounded memory at any size
    (``quantile_arrays``: radix selection over the input, stored once unless it already is)."""
    q = quantile_arrays(df, cols, [0.25, 0.75], by, is_stored)
    out = q.select(*by, "column", F.col("values")[0].alias("q1"), F.col("values")[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return out.withColumns({"iqr": iqr, "lower": F.col("q1") - F.lit(k) * iqr,
                            "upper": F.col("q3") + F.lit(k) * iqr})


def outlier_ffill(df: DataFrame, cols: Sequence[str] = PRICE_COLS, ticker: str = "symbol",
                  order_by: Sequence[str] = ("date",), fence_by: str | None = None,
                  k: float = FENCE_K) -> DataFrame:
    """Values outside the ``k``·IQR fences become null and are forward-filled.

    Fences are computed over all tickers together by default (``fence_by=None``, as the
    reference does) or per ticker (``fence_by='symbol'``). The fill is always per ticker
    in ``order_by`` order — a deliberate deviation: the reference fills across ticker
    borders in list order, which leaks one ticker's price into the next and, as a
    global window, would run in a single task. A leading outlier therefore stays null.

    Plan: the input is stored once; the fences (a handful of numbers) are selected over it —
    a scalar subquery when global, a join with one row per fence group otherwise — then one
    window per ticker.
    """
    by = [fence_by] if fence_by else []
    df = stored(df, "bars")
    fences = iqr_bounds(df, cols, by, k, is_stored=True).groupBy(*by).agg(F.struct(*[
        F.first(F.when(F.col("column") == c, F.struct("lower", "upper")), ignorenulls=True).alias(c)
        for c in cols]).alias("_fence"))
    if by:
        # one row per ticker: joined on the key, AQE broadcasts it when measured small
        fenced, own = df.join(fences.withColumnRenamed(fence_by, "_by"),
                              F.col(fence_by).eqNullSafe(F.col("_by")), "left"), F.col("_fence")
    else:
        # global fences: one scalar subquery yielding a struct of all fences, named once
        fenced, own = df.select("*", F.explode(F.array(fences.scalar())).alias("_fence")), F.col("_fence")
    w = (Window.partitionBy(ticker).orderBy(*order_by)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def filled(c: str) -> Column:
        outside = (F.col(c) < own[c]["lower"]) | (F.col(c) > own[c]["upper"])
        return F.last(F.when(outside, F.lit(None).cast("double")).otherwise(F.col(c)), ignorenulls=True).over(w)

    return fenced.select(*[filled(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def daily_return(df: DataFrame, close: str = "close", ticker: str = "symbol",
                 order_by: Sequence[str] = ("date",), out: str = "daily_return") -> DataFrame:
    """``close / previous close - 1`` per ticker; previous 0 or null → null. Only added
    when ``out`` is not already a column."""
    if out in df.columns:
        return df
    w = Window.partitionBy(ticker).orderBy(*order_by)
    return df.withColumn(out, F.try_divide(F.col(close), F.lag(close).over(w)) - 1)


def clean_bars(df: DataFrame, ticker: str = "symbol", date: str = "date",
               fence_by: str | None = None) -> DataFrame:
    """The stock cleaner: drop incomplete bars → outlier fences + fill → daily return →
    calendar names."""
    out = drop_incomplete_bars(df)
    out = outlier_ffill(out, ticker=ticker, order_by=(date,), fence_by=fence_by)
    out = daily_return(out, ticker=ticker, order_by=(date,))
    return out.withColumns({"day_of_week": F.date_format(date, "EEEE"),
                            "month": F.date_format(date, "MMMM")})


def symbol_filter(df: DataFrame, values: Sequence[str], col: str = "symbol") -> DataFrame:
    """Keep listed values (an ``IN`` filter the Parquet scan can push down)."""
    return df.where(F.col(col).isin(list(values)))
