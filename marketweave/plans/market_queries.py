"""Registered queries over price bars, sentiment and forecasts (dashboard pages and the
stock cleaner). Each has a DuckDB oracle over the same derived views."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketweave.functions.formatting import fixed2_sql, fixed_sql
from marketweave.operators import analytics as A
from marketweave.operators import stock as S
from marketweave.plans.catalog import NN, D, R, dtxt, query, report
from marketweave.session import stored
from marketweave.sources import fixtures as fx

PRICE = ("open", "high", "low", "close")


# ------------------------------------------------------------ sentiment vs. price page

@query("sentiment_price_join", f"""
    SELECT symbol, {D('date', 'date')}, price, price_volume,
           {R('sentiment_score', 'sentiment_score')}, sentiment_volume
    FROM v_sent_price WHERE price IS NOT NULL AND sentiment_score IS NOT NULL""",
       ("v_sent_price",))
def q_sentiment_price_join(spark, sf):
    j = A.sentiment_price_join(fx.bars(spark, sf), fx.sentiment_daily(spark, sf),
                               price_col="close")
    return report(j, round_cols=("sentiment_score",), date_cols=("date",))


_CORR_SQL = """
    CASE WHEN stddev_pop(xx) * stddev_pop(yy) > 1e-12
         THEN covar_pop(xx, yy) / (stddev_pop(xx) * stddev_pop(yy)) END"""
_CORR_FROM = """(SELECT symbol, sentiment_score, price,
                        CASE WHEN price IS NOT NULL THEN sentiment_score END AS xx,
                        CASE WHEN sentiment_score IS NOT NULL THEN price END AS yy
                 FROM v_sent_price)"""


@query("pearson_corr", f"""
    SELECT symbol, {R(_CORR_SQL, 'correlation')} FROM {_CORR_FROM} GROUP BY symbol""",
       ("v_sent_price",))
def q_pearson_corr(spark, sf):
    c = A.pearson_corr(fx.sent_price(spark, sf))
    return report(c, round_cols=("correlation",))


_STRENGTH_SQL = """CASE WHEN r IS NULL THEN 'No correlation'
                        WHEN r > 0.7 THEN 'Strong positive'
                        WHEN r > 0.3 THEN 'Moderate positive'
                        WHEN r > -0.3 THEN 'Weak'
                        WHEN r > -0.7 THEN 'Moderate negative'
                        ELSE 'Strong negative' END"""


@query("corr_strength", f"""
    SELECT symbol, {R('r', 'correlation')}, {_STRENGTH_SQL} AS strength
    FROM (SELECT symbol, {_CORR_SQL} AS r FROM {_CORR_FROM} GROUP BY symbol)""",
       ("v_sent_price",))
def q_corr_strength(spark, sf):
    c = A.correlation_report(fx.sent_price(spark, sf)).select("symbol", "correlation",
                                                              "strength")
    return report(c, round_cols=("correlation",))


@query("correlation_report", f"""
    SELECT symbol, n, {R('r', 'correlation')}, {_STRENGTH_SQL} AS strength,
           {R('slope', 'slope')}, {R('intercept', 'intercept')}, {R('r2', 'r2')}
    FROM (SELECT symbol, count(xx) FILTER (WHERE yy IS NOT NULL) AS n, {_CORR_SQL} AS r,
                 {NN('regr_slope(price, sentiment_score)')} AS slope,
                 {NN('regr_intercept(price, sentiment_score)')} AS intercept,
                 {NN('regr_r2(price, sentiment_score)')} AS r2
          FROM {_CORR_FROM} GROUP BY symbol)""", ("v_sent_price",))
def q_correlation_report(spark, sf):
    """Flagship: J01 -> A04 + A05 + A06 in one aggregate per symbol."""
    j = A.sentiment_price_join(fx.bars(spark, sf), fx.sentiment_daily(spark, sf),
                               price_col="close")
    r = A.correlation_report(j).select("symbol", "n", "correlation", "strength", "slope",
                                       "intercept", "r2")
    return report(r, round_cols=("correlation", "slope", "intercept", "r2"))


@query("ols_trend", f"""
    SELECT symbol, CAST(regr_count(price, sentiment_score) AS BIGINT) AS n,
           {R(NN('regr_slope(price, sentiment_score)'), 'slope')},
           {R(NN('regr_intercept(price, sentiment_score)'), 'intercept')},
           {R(NN('regr_r2(price, sentiment_score)'), 'r2')}
    FROM v_sent_price GROUP BY symbol""", ("v_sent_price",))
def q_ols_trend(spark, sf):
    t = A.ols_trend(fx.sent_price(spark, sf)).withColumn("n", F.col("n").cast("bigint"))
    return report(t, round_cols=("slope", "intercept", "r2"))


@query("dual_series", f"""
    SELECT symbol, {D('date', 'date')}, price, {R('sentiment_score', 'sentiment_score')},
           row_number() OVER (PARTITION BY symbol ORDER BY v_sent_price.date) AS row_number
    FROM v_sent_price""", ("v_sent_price",))
def q_dual_series(spark, sf):
    return report(A.dual_series(fx.sent_price(spark, sf)), round_cols=("sentiment_score",),
                  date_cols=("date",))


# ------------------------------------------------------------ stock cleaner

@query("flatten_colnames", f"""
    SELECT symbol, {D('date', 'date')}, close AS "Close", volume AS "Volume" FROM v_bars""",
       ("v_bars",))
def q_flatten_colnames(spark, sf):
    """Bars shaped like a one-ticker multi-level download (``Close.<ticker>``) flattened
    to first-level names."""
    b = fx.bars(spark, sf).select(
        "symbol", "date", F.struct(F.col("close").alias("ticker")).alias("Close"),
        F.struct(F.col("volume").alias("ticker")).alias("Volume"))
    return report(S.flatten_colnames(b), date_cols=("date",))


@query("bar_range", f"""
    SELECT symbol, {D('date', 'date')}, high, low, high - low AS volatility FROM v_bars""",
       ("v_bars",))
def q_bar_range(spark, sf):
    b = S.bar_range(fx.bars(spark, sf)).select("symbol", "date", "high", "low", "volatility")
    return report(b, date_cols=("date",))


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in ("open", "high", "low", "close", "volume"))


@query("drop_incomplete_bars", f"""
    SELECT symbol, {D('date', 'date')}, open, high, low, close, volume
    FROM v_bars_dirty WHERE {_COMPLETE}""", ("v_bars_dirty",))
def q_drop_incomplete_bars(spark, sf):
    return report(S.drop_incomplete_bars(fx.bars_dirty(spark, sf)), date_cols=("date",))


@query("calendar_features", f"""
    SELECT symbol, {D('date', 'date')}, dayname(date) AS day_of_week,
           monthname(date) AS month, CAST(year(date) AS BIGINT) AS year FROM v_bars""",
       ("v_bars",))
def q_calendar_features(spark, sf):
    c = S.calendar_features(fx.bars(spark, sf).select("symbol", "date"))
    return report(c.withColumn("year", F.col("year").cast("bigint")), date_cols=("date",))


def _iqr_sql(src: str) -> str:
    parts = []
    for c in PRICE:
        parts.append(f"""
        SELECT '{c}' AS "column", q1, q3, q3 - q1 AS iqr, q1 - 3 * (q3 - q1) AS lower,
               q3 + 3 * (q3 - q1) AS upper
        FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src})""")
    return " UNION ALL ".join(parts)


@query("iqr_bounds", f"""
    SELECT "column", {R('q1', 'q1')}, {R('q3', 'q3')}, {R('iqr', 'iqr')},
           {R('lower', 'lower')}, {R('upper', 'upper')}
    FROM ({_iqr_sql(f"(SELECT * FROM v_bars_dirty WHERE {_COMPLETE})")})""",
       ("v_bars_dirty",))
def q_iqr_bounds(spark, sf):
    b = S.iqr_bounds(S.drop_incomplete_bars(fx.bars_dirty(spark, sf)))
    return report(b, round_cols=("q1", "q3", "iqr", "lower", "upper"))


@query("iqr_bounds_scalable", f"""
    SELECT "column", {R('q1', 'q1')}, {R('q3', 'q3')}, {R('iqr', 'iqr')},
           {R('lower', 'lower')}, {R('upper', 'upper')}
    FROM ({_iqr_sql(f"(SELECT * FROM v_bars_dirty WHERE {_COMPLETE})")})""",
       ("v_bars_dirty",))
def q_iqr_bounds_scalable(spark, sf):
    """The same fences over bars that are stored already: the selection reads them as they
    are, however often, and runs no job of its own."""
    b = S.iqr_bounds(stored(S.drop_incomplete_bars(fx.bars_dirty(spark, sf)), "bars"), is_stored=True)
    return report(b, round_cols=("q1", "q3", "iqr", "lower", "upper"))


def _ffill_sql(src: str, extra: str = "") -> str:
    fences = ", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in PRICE)
    masked = ", ".join(
        f"""CASE WHEN {c} < {c}_q1 - 3 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 3 * ({c}_q3 - {c}_q1)
                 THEN NULL ELSE {c} END AS {c}""" for c in PRICE)
    filled = ", ".join(
        f"""last_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}""" for c in PRICE)
    return f"""
        SELECT symbol, date, {filled}, volume{extra}
        FROM (SELECT symbol, date, {masked}, volume
              FROM {src} b, (SELECT {fences} FROM {src}) f)"""


_CLEAN_SRC = f"(SELECT * FROM v_bars_dirty WHERE {_COMPLETE})"


@query("outlier_ffill", f"""
    SELECT symbol, {D('date', 'date')}, open, high, low, close, volume
    FROM ({_ffill_sql(_CLEAN_SRC)})""", ("v_bars_dirty",))
def q_outlier_ffill(spark, sf):
    b = S.outlier_ffill(S.drop_incomplete_bars(fx.bars_dirty(spark, sf)))
    return report(b, date_cols=("date",))


@query("daily_return", f"""
    SELECT symbol, {D('date', 'date')}, close,
           {R('close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1',
              'daily_return')}
    FROM v_bars""", ("v_bars",))
def q_daily_return(spark, sf):
    b = S.daily_return(fx.bars(spark, sf).select("symbol", "date", "close"))
    return report(b, round_cols=("daily_return",), date_cols=("date",))


@query("clean_stock", f"""
    SELECT symbol, {D('date', 'date')}, open, high, low, close, volume,
           {R('close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1',
              'daily_return')},
           dayname(date) AS day_of_week, monthname(date) AS month
    FROM ({_ffill_sql(_CLEAN_SRC)})""", ("v_bars_dirty",))
def q_clean_stock(spark, sf):
    b = S.clean_bars(fx.bars_dirty(spark, sf))
    return report(b, round_cols=("daily_return",), date_cols=("date",))


@query("flatten_ticker_map", f"""
    SELECT symbol AS ticker, {D('date', 'date')}, open, high, low, close, volume FROM v_bars""",
       ("v_bars",))
def q_flatten_ticker_map(spark, sf):
    """Bars packed as ``{ticker: [bars]}`` JSON documents (one per ticker-year, so no
    document grows with history) and flattened back."""
    b = fx.bars(spark, sf)
    packed = (b.groupBy("symbol", F.year("date").alias("y"))
               .agg(F.to_json(F.create_map(F.col("symbol"), F.collect_list(
                   F.struct("date", "open", "high", "low", "close", "volume")))).alias("value")))
    flat = S.flatten_ticker_map(packed, "value", "date date, open double, high double, "
                                                 "low double, close double, volume bigint")
    return report(flat, date_cols=("date",))


@query("union_tickers", f"""
    SELECT symbol, {D('date', 'date')}, close FROM v_bars""", ("v_bars",))
def q_union_tickers(spark, sf):
    """Per-ticker frames appended into one table (a single plan, no driver loop)."""
    b = fx.bars(spark, sf).select("symbol", "date", "close")
    parts = [b.where(F.col("symbol") < "Brand#2"), b.where(F.col("symbol") >= "Brand#2")]
    return report(A.union_frames(parts), date_cols=("date",))


_SYMS = ("Brand#1", "Brand#7", "Brand#13", "Brand#25")


@query("symbol_filter", f"""
    SELECT symbol, {D('date', 'date')}, close FROM v_bars
    WHERE symbol IN ({", ".join(f"'{s}'" for s in _SYMS)})""", ("v_bars",))
def q_symbol_filter(spark, sf):
    b = S.symbol_filter(fx.bars(spark, sf), _SYMS).select("symbol", "date", "close")
    return report(b, date_cols=("date",))


@query("last_n_by_symbol", f"""
    SELECT symbol, {D('date', 'date')}, close FROM v_bars
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 30""", ("v_bars",))
def q_last_n_by_symbol(spark, sf):
    b = A.last_n_by_symbol(fx.bars(spark, sf).select("symbol", "date", "close"), 30)
    return report(b, date_cols=("date",))


@query("bounded_history", f"""
    SELECT symbol, {D('date', 'date')}, close FROM v_bars
    WHERE date > (SELECT max(date) FROM v_bars) - 60""", ("v_bars",))
def q_bounded_history(spark, sf):
    b = A.bounded_history(fx.bars(spark, sf).select("symbol", "date", "close"), 60)
    return report(b, date_cols=("date",))


@query("bounded_history_by_symbol", f"""
    SELECT b.symbol, {D('b.date', 'date')}, b.close
    FROM v_bars b JOIN (SELECT symbol, max(date) AS mx FROM v_bars GROUP BY symbol) m
      ON b.symbol = m.symbol
    WHERE b.date > m.mx - 60""", ("v_bars",))
def q_bounded_history_by_symbol(spark, sf):
    """The last 60 days of every symbol, each relative to its own latest bar."""
    b = A.bounded_history(fx.bars(spark, sf).select("symbol", "date", "close"), 60,
                          by=("symbol",))
    return report(b, date_cols=("date",))


@query("last_n_one_symbol", f"""
    SELECT symbol, {D('date', 'date')}, close, volume FROM v_bars WHERE symbol = 'Brand#7'
    ORDER BY date DESC LIMIT 30""", ("v_bars",))
def q_last_n_one_symbol(spark, sf):
    """One symbol's latest 30 bars (the dashboard's single-symbol read): equality filter,
    sort and limit as one find."""
    b = fx.bars(spark, sf).select("symbol", "date", "close", "volume")
    return report(A.find_documents(b, {"symbol": "Brand#7"}, sort=[("date", -1)], limit=30),
                  date_cols=("date",))


@query("calendar_spine", f"""
    SELECT symbol, {D('start + CAST(i AS INTEGER)', 'date')}, CAST(100 + i AS DOUBLE) AS trend
    FROM (SELECT symbol, min(date) AS start, unnest(range(30)) AS i
          FROM v_bars GROUP BY symbol)""", ("v_bars",))
def q_calendar_spine(spark, sf):
    starts = fx.bars(spark, sf).groupBy("symbol").agg(F.min("date").alias("start"))
    return report(A.calendar_spine(starts, 30), date_cols=("date",))


# ------------------------------------------------------------ event page

@query("event_phase", f"""
    SELECT symbol, {D('date', 'date')}, price,
           CASE WHEN rn <= 10 THEN 'Before' WHEN rn <= 20 THEN 'During' ELSE 'After' END AS phase
    FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn
          FROM v_event_prices)""", ("v_event_prices",))
def q_event_phase(spark, sf):
    return report(A.event_phase(fx.event_prices(spark, sf)), date_cols=("date",))


_PHASES = """(SELECT symbol, price,
                     CASE WHEN rn <= 10 THEN 'Before' WHEN rn <= 20 THEN 'During'
                          ELSE 'After' END AS phase
              FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn
                    FROM v_event_prices))"""
_AVGS = f"""(SELECT symbol, avg(price) FILTER (WHERE phase = 'Before') AS b,
                    avg(price) FILTER (WHERE phase = 'During') AS d,
                    avg(price) FILTER (WHERE phase = 'After') AS a
             FROM {_PHASES} GROUP BY symbol)"""


@query("phase_averages", f"""
    SELECT symbol, {R('b', 'before_avg')}, {R('d', 'during_avg')}, {R('a', 'after_avg')}
    FROM {_AVGS}""", ("v_event_prices",))
def q_phase_averages(spark, sf):
    p = A.phase_averages(A.event_phase(fx.event_prices(spark, sf)))
    return report(p, round_cols=("before_avg", "during_avg", "after_avg"))


@query("event_impact", f"""
    SELECT symbol, {R('b', 'before_avg')}, {R('d', 'during_avg')}, {R('a', 'after_avg')},
           {R('d - b', 'during_change')}, {R('a - d', 'after_change')},
           {R('abs(d - b)', 'during_change_abs')}, {R('abs(a - d)', 'after_change_abs')},
           CASE WHEN d > b THEN 'increased' ELSE 'decreased' END AS during_label,
           CASE WHEN a > d THEN 'continued to increase' ELSE 'began to decrease' END
             AS after_label,
           CASE WHEN a > b THEN 'Positive' ELSE 'Negative' END AS overall_impact
    FROM {_AVGS}""", ("v_event_prices",))
def q_event_impact(spark, sf):
    p = A.event_impact(A.phase_averages(A.event_phase(fx.event_prices(spark, sf))))
    return report(p, round_cols=("before_avg", "during_avg", "after_avg", "during_change",
                                 "after_change", "during_change_abs", "after_change_abs"))


# ------------------------------------------------------------ forecast page

@query("overall_change", f"""
    SELECT symbol, first_price, last_price, {R('last_price - first_price', 'overall_change')},
           {R('(last_price - first_price) / nullif(first_price, 0) * 100', 'overall_change_pct')}
    FROM (SELECT symbol, arg_min(predicted_price, date) AS first_price,
                 arg_max(predicted_price, date) AS last_price
          FROM v_preds GROUP BY symbol)""", ("v_preds",))
def q_overall_change(spark, sf):
    o = A.overall_change(fx.predictions(spark, sf))
    return report(o, round_cols=("overall_change", "overall_change_pct"))


@query("date_extent", f"""
    SELECT symbol, {D('min(date)', 'first_date')}, {D('max(date)', 'last_date')}
    FROM v_preds GROUP BY symbol""", ("v_preds",))
def q_date_extent(spark, sf):
    return report(A.date_extent(fx.predictions(spark, sf)),
                  date_cols=("first_date", "last_date"))


@query("explode_predictions", f"""
    SELECT symbol AS ticker, 'naive' AS model_used, {D('date', 'date')},
           {R('predicted_return', 'predicted_return')}, predicted_price
    FROM v_preds""", ("v_preds",))
def q_explode_predictions(spark, sf):
    """Forecasts stored as ``date -> {predicted_return, predicted_price}`` maps (one per
    ticker-month) and exploded back into rows."""
    p = fx.predictions(spark, sf)
    packed = (p.groupBy(F.col("symbol").alias("ticker"), F.trunc("date", "month").alias("m"))
               .agg(F.map_from_entries(F.collect_list(F.struct(
                   dtxt("date"), F.struct("predicted_return", "predicted_price"))))
                    .alias("predictions"))
               .withColumn("model_used", F.lit("naive")))
    e = A.explode_predictions(packed)
    return report(e, round_cols=("predicted_return",), date_cols=("date",))


@query("rename_display", f"""
    SELECT symbol AS "Symbol", {D('date', '"Date"')},
           {fixed2_sql('predicted_price', prefix='$')} AS "Predicted Price",
           {fixed2_sql('predicted_return * 100', suffix='%', signed=True)} AS "Predicted Change"
    FROM v_preds WHERE predicted_price IS NOT NULL AND predicted_return IS NOT NULL""",
       ("v_preds",))
def q_rename_display(spark, sf):
    p = fx.predictions(spark, sf).where("predicted_price IS NOT NULL AND "
                                        "predicted_return IS NOT NULL")
    f = A.format_metrics(p, price="predicted_price", ret="predicted_return").select(
        "symbol", dtxt("date").alias("date"), "price_text", "change_text")
    return A.rename_display(f, {"symbol": "Symbol", "date": "Date",
                                "price_text": "Predicted Price",
                                "change_text": "Predicted Change"})


@query("format_metrics", f"""
    SELECT symbol, {fixed2_sql('predicted_price', prefix='$')} AS price_text,
           {fixed2_sql('predicted_return * 100', suffix='%', signed=True)} AS change_text,
           CASE WHEN predicted_return > 0 THEN 'up' ELSE 'down' END AS direction
    FROM v_preds WHERE predicted_price IS NOT NULL AND predicted_return IS NOT NULL""",
       ("v_preds",))
def q_format_metrics(spark, sf):
    p = fx.predictions(spark, sf).where("predicted_price IS NOT NULL AND "
                                        "predicted_return IS NOT NULL")
    return A.format_metrics(p, price="predicted_price", ret="predicted_return").select(
        "symbol", "price_text", "change_text", "direction")


@query("clamp", f"""
    SELECT symbol, {D('date', 'date')},
           CASE WHEN predicted_return IS NULL THEN NULL
                ELSE least(1.0, greatest(0.0, predicted_return)) END AS return_01,
           CASE WHEN predicted_price IS NULL THEN NULL ELSE greatest(0.0, predicted_price - 1000)
                END AS excess_price
    FROM v_preds""", ("v_preds",))
def q_clamp(spark, sf):
    p = fx.predictions(spark, sf)
    return report(p.select("symbol", "date",
                           A.clamp("predicted_return", 0.0, 1.0).alias("return_01"),
                           A.clamp(F.col("predicted_price") - 1000, 0.0).alias("excess_price")),
                  date_cols=("date",))


# ------------------------------------------------------------ model performance page

_METRICS_FROM = """(SELECT *, CASE WHEN actual_price IS NOT NULL AND predicted_price IS NOT NULL
                                  THEN predicted_price - actual_price END AS ee,
                             CASE WHEN actual_price IS NOT NULL AND predicted_price IS NOT NULL
                                  THEN actual_price END AS aa
                   FROM v_preds)"""
_METRICS_SEL = """count(ee) AS n, sqrt(avg(ee * ee)) AS rmse, avg(abs(ee)) AS mae,
                  1 - sum(ee * ee) / nullif(var_pop(aa) * count(ee), 0) AS r2,
                  avg(CAST(sign(actual_return) = sign(predicted_return) AS INTEGER)) AS accuracy"""
_METRIC_COLS = ("rmse", "mae", "r2", "accuracy")


@query("regression_metrics", f"""
    SELECT symbol, n, {", ".join(R(c, c) for c in _METRIC_COLS)}
    FROM (SELECT symbol, {_METRICS_SEL} FROM {_METRICS_FROM} GROUP BY symbol)""", ("v_preds",))
def q_regression_metrics(spark, sf):
    return report(A.regression_metrics(fx.predictions(spark, sf)), round_cols=_METRIC_COLS)


@query("regression_metrics_overall", f"""
    SELECT n, {", ".join(R(c, c) for c in _METRIC_COLS)}
    FROM (SELECT {_METRICS_SEL} FROM {_METRICS_FROM})""", ("v_preds",))
def q_regression_metrics_overall(spark, sf):
    return report(A.regression_metrics(fx.predictions(spark, sf), by=()),
                  round_cols=_METRIC_COLS)


@query("confusion_matrix", """
    SELECT r.actual, coalesce(predicted_up, 0) AS predicted_up,
           coalesce(predicted_down, 0) AS predicted_down
    FROM (VALUES ('Actual Up'), ('Actual Down')) r(actual) LEFT JOIN (
    SELECT actual, count(*) FILTER (WHERE pred = 'Predicted Up') AS predicted_up,
           count(*) FILTER (WHERE pred = 'Predicted Down') AS predicted_down
    FROM (SELECT CASE WHEN actual_return > 0 THEN 'Actual Up' ELSE 'Actual Down' END AS actual,
                 CASE WHEN predicted_return > 0 THEN 'Predicted Up' ELSE 'Predicted Down' END
                   AS pred
          FROM v_preds WHERE actual_return IS NOT NULL AND predicted_return IS NOT NULL)
    GROUP BY actual) c ON c.actual = r.actual""", ("v_preds",))
def q_confusion_matrix(spark, sf):
    return A.confusion_matrix(fx.predictions(spark, sf))


@query("best_symbol", f"""
    SELECT symbol, {R('rmse', 'rmse')}, {R('accuracy', 'accuracy')}
    FROM (SELECT symbol, {_METRICS_SEL} FROM {_METRICS_FROM} GROUP BY symbol)
    ORDER BY accuracy DESC NULLS LAST, symbol LIMIT 1""", ("v_preds",))
def q_best_symbol(spark, sf):
    b = A.best_symbol(A.regression_metrics(fx.predictions(spark, sf)))
    return report(b, round_cols=("rmse", "accuracy"))


@query("metric_history", f"""
    SELECT {D('date', 'date')},
           {R('CASE WHEN r IS NULL THEN NULL ELSE greatest(0.0, r) END', 'rmse')},
           {R('CASE WHEN a IS NULL THEN NULL ELSE least(1.0, greatest(0.0, a)) END', 'accuracy')}
    FROM (SELECT date, sqrt(avg((predicted_price - actual_price) ** 2)) AS r,
                 avg(CAST(sign(actual_return) = sign(predicted_return) AS INTEGER)) AS a
          FROM v_preds GROUP BY date)""", ("v_preds",))
def q_metric_history(spark, sf):
    return report(A.metric_history(fx.predictions(spark, sf)), round_cols=("rmse", "accuracy"),
                  date_cols=("date",))


@query("metrics_long", f"""
    SELECT symbol, metric, {R('value', 'value')} FROM (
      UNPIVOT (SELECT symbol, {_METRICS_SEL} FROM {_METRICS_FROM} GROUP BY symbol)
      ON rmse, mae, r2, accuracy INTO NAME metric VALUE value)""", ("v_preds",))
def q_metrics_long(spark, sf):
    m = A.metrics_long(A.regression_metrics(fx.predictions(spark, sf)))
    return report(m, round_cols=("value",))


@query("confusion_wide", """
    SELECT r.actual, coalesce(predicted_up, 0) AS predicted_up,
           coalesce(predicted_down, 0) AS predicted_down
    FROM (VALUES ('Actual Up'), ('Actual Down')) r(actual) LEFT JOIN (
    SELECT actual, count(*) FILTER (WHERE pred = 'Predicted Up') AS predicted_up,
           count(*) FILTER (WHERE pred = 'Predicted Down') AS predicted_down
    FROM (SELECT symbol, CASE WHEN actual_return > 0 THEN 'Actual Up' ELSE 'Actual Down' END
                   AS actual,
                 CASE WHEN predicted_return > 0 THEN 'Predicted Up' ELSE 'Predicted Down' END
                   AS pred
          FROM v_preds WHERE actual_return IS NOT NULL AND predicted_return IS NOT NULL
            AND symbol IN ('Brand#1', 'Brand#2', 'Brand#3'))
    GROUP BY actual) c ON c.actual = r.actual""", ("v_preds",))
def q_confusion_wide(spark, sf):
    """The 2x2 pivot restricted to a selection of symbols (the page's stock picker)."""
    p = S.symbol_filter(fx.predictions(spark, sf), ("Brand#1", "Brand#2", "Brand#3"))
    return A.confusion_matrix(p)


@query("find_documents", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def q_find_documents(spark, sf):
    from marketweave.sources.tables import read_table
    o = read_table(spark, sf, "orders")
    return A.find_documents(o, {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"},
                            ["o_orderkey", "o_custkey", "o_totalprice"],
                            [("o_totalprice", -1), ("o_orderkey", 1)], 20)



@query("format_prediction", f"""
    SELECT p.symbol, {D('p.date', 'date')},
           CASE WHEN p.predicted_return * 100 > 0
                THEN '📈 ' || {fixed_sql('p.predicted_return * 100', 2, signed=True)}
                ELSE '📉 ' || {fixed_sql('p.predicted_return * 100', 2)} END
           || ' (' || {fixed_sql('m.accuracy * 100', 1)} || '% confidence)' AS prediction_text
    FROM v_preds p JOIN (SELECT symbol, {_METRICS_SEL} FROM {_METRICS_FROM} GROUP BY symbol) m
      ON p.symbol = m.symbol
    WHERE p.predicted_return IS NOT NULL""", ("v_preds",))
def q_format_prediction(spark, sf):
    """Each forecast as the dashboard's marker text, with the symbol's directional
    accuracy as the confidence (a per-symbol metric joined to its forecasts)."""
    p = fx.predictions(spark, sf)
    acc = A.regression_metrics(p).select("symbol", "accuracy")
    j = p.where(F.col("predicted_return").isNotNull()).join(acc, "symbol")
    return j.select("symbol", dtxt("date").alias("date"),
                    A.prediction_text(F.col("predicted_return") * 100, "accuracy")
                    .alias("prediction_text"))
