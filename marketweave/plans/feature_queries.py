"""Registered queries for model features, splits, signals and the MLlib models."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketweave.operators import features as FE
from marketweave.operators import linear as LI
from marketweave.operators import models as MO
from marketweave.operators import tables as TB
from marketweave.plans.catalog import D, R, TS, query, report
from marketweave.session import cut_lineage
from marketweave.sources import fixtures as fx

W = "PARTITION BY symbol ORDER BY date"

_BARS_FEAT = f"""
    SELECT symbol, date, close, high, low, volume,
           close / nullif(lag(close) OVER ({W}), 0) - 1 AS daily_return
    FROM v_bars"""

_BARS_FEAT2 = f"""
    SELECT *, stddev_samp(daily_return) OVER ({W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
                AS volatility_lag1,
              lag(high - low, 1) OVER ({W}) AS range_lag1,
              CAST(volume AS DOUBLE) / nullif(avg(volume) OVER ({W} ROWS BETWEEN 20 PRECEDING
                                                             AND 1 PRECEDING), 0) AS volume_ratio,
              lead(close, 5) OVER ({W}) / nullif(close, 0) - 1 AS target_return_5
    FROM ({_BARS_FEAT})"""

_MOMENTUM = f"""
    SELECT symbol, date, sentiment_score,
           avg(sentiment_score) OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) -
           avg(sentiment_score) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
             AS sentiment_momentum
    FROM v_sent"""

_FEATURES_SQL = f"""
    SELECT b.symbol, b.date, b.daily_return, b.volatility_lag1, b.range_lag1, b.volume_ratio,
           coalesce(b.volume_ratio > 2.0, false) AS volume_spike, b.target_return_5,
           s.sentiment_score, s.sentiment_momentum
    FROM ({_BARS_FEAT2}) b LEFT JOIN ({_MOMENTUM}) s ON b.symbol = s.symbol AND b.date = s.date"""

_FEATURE_COLS = ("daily_return", "volatility_lag1", "range_lag1", "volume_ratio",
                 "target_return_5", "sentiment_score", "sentiment_momentum")


def _features(spark, sf):
    return FE.feature_table(fx.bars(spark, sf), fx.sentiment_daily(spark, sf))


@query("sentiment_momentum", f"""
    SELECT symbol, {D('date', 'date')}, {R('sentiment_momentum', 'sentiment_momentum')}
    FROM ({_MOMENTUM})""", ("v_sent",))
def q_sentiment_momentum(spark, sf):
    m = FE.sentiment_momentum(fx.sentiment_daily(spark, sf))
    return report(m.select("symbol", "date", "sentiment_momentum"),
                  round_cols=("sentiment_momentum",), date_cols=("date",))


@query("lagged_volatility", f"""
    SELECT symbol, {D('date', 'date')}, {R('volatility_lag1', 'volatility_lag1')}, range_lag1
    FROM ({_BARS_FEAT2})""", ("v_bars",))
def q_lagged_volatility(spark, sf):
    b = fx.bars(spark, sf)
    b = FE.lagged_volatility(b.withColumn("daily_return", F.try_divide(
        F.col("close"), F.lag("close").over(FE._w("symbol", "date"))) - 1))
    return report(b.select("symbol", "date", "volatility_lag1", "range_lag1"),
                  round_cols=("volatility_lag1",), date_cols=("date",))


@query("volume_spike", f"""
    SELECT symbol, {D('date', 'date')}, {R('volume_ratio', 'volume_ratio')},
           coalesce(volume_ratio > 2.0, false) AS volume_spike
    FROM ({_BARS_FEAT2})""", ("v_bars",))
def q_volume_spike(spark, sf):
    v = FE.volume_spike(fx.bars(spark, sf))
    return report(v.select("symbol", "date", "volume_ratio", "volume_spike"),
                  round_cols=("volume_ratio",), date_cols=("date",))


@query("forward_target", f"""
    SELECT symbol, {D('date', 'date')}, {R('target_return_5', 'target_return_5')}
    FROM ({_BARS_FEAT2})""", ("v_bars",))
def q_forward_target(spark, sf):
    t = FE.forward_target(fx.bars(spark, sf))
    return report(t.select("symbol", "date", "target_return_5"),
                  round_cols=("target_return_5",), date_cols=("date",))


@query("feature_table", f"""
    SELECT symbol, {D('date', 'date')}, {", ".join(R(c, c) for c in _FEATURE_COLS)},
           volume_spike
    FROM ({_FEATURES_SQL})""", ("v_bars", "v_sent"))
def q_feature_table(spark, sf):
    f = _features(spark, sf).select("symbol", "date", *_FEATURE_COLS, "volume_spike")
    return report(f, round_cols=_FEATURE_COLS, date_cols=("date",))


_SPLIT_SQL = f"""
    SELECT *, CASE WHEN rn <= (n - ceil(n * 0.2)) - ceil((n - ceil(n * 0.2)) * 0.25) THEN 'train'
                   WHEN rn <= n - ceil(n * 0.2) THEN 'valid' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER ({W}) AS rn, count(*) OVER (PARTITION BY symbol) AS n
          FROM ({_FEATURES_SQL}))"""


@query("time_split", f"""
    SELECT symbol, {D('date', 'date')}, split FROM ({_SPLIT_SQL})""", ("v_bars", "v_sent"))
def q_time_split(spark, sf):
    s = FE.time_split(fx.bars(spark, sf).select("symbol", "date"))
    return report(s, date_cols=("date",))


@query("scale_features", f"""
    WITH s AS ({_SPLIT_SQL}),
         st AS (SELECT avg(daily_return) AS a1, stddev_samp(daily_return) AS b1,
                       avg(volume_ratio) AS a2, stddev_samp(volume_ratio) AS b2
                FROM s WHERE split = 'train')
    SELECT symbol, {D('date', 'date')}, split,
           {R('(daily_return - st.a1) / nullif(st.b1, 0)', 'daily_return_scaled')},
           {R('(volume_ratio - st.a2) / nullif(st.b2, 0)', 'volume_ratio_scaled')}
    FROM s, st""", ("v_bars", "v_sent"))
def q_scale_features(spark, sf):
    s = FE.time_split(_features(spark, sf))
    sc = FE.scale_features(s, ["daily_return", "volume_ratio"])
    return report(sc.select("symbol", "date", "split", "daily_return_scaled",
                            "volume_ratio_scaled"),
                  round_cols=("daily_return_scaled", "volume_ratio_scaled"), date_cols=("date",))


@query("trading_signal", f"""
    SELECT symbol, {D('date', 'date')},
           CASE WHEN sentiment_momentum > 0.05 AND volume_spike THEN 'up'
                WHEN sentiment_momentum < -0.05 AND volume_spike THEN 'down'
                ELSE 'none' END AS signal
    FROM ({_FEATURES_SQL})""", ("v_bars", "v_sent"))
def q_trading_signal(spark, sf):
    t = FE.trading_signal(_features(spark, sf))
    return report(t.select("symbol", "date", "signal"), date_cols=("date",))


# ------------------------------------------------------------ models

def _model_rows(spark, sf):
    return MO.horizon_rows(FE.time_split(_features(spark, sf)))


# (ticker, day, h) rows whose target day lies in the split of the day
_FILLED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in MO.FEATURES)
_ROWS_SQL = f"""
    SELECT symbol, date, split, h, label, {_FILLED}
    FROM (SELECT s.*, h,
                 CASE h WHEN 1 THEN lead(daily_return, 1) OVER w WHEN 2 THEN lead(daily_return, 2) OVER w
                        WHEN 3 THEN lead(daily_return, 3) OVER w WHEN 4 THEN lead(daily_return, 4) OVER w
                        ELSE lead(daily_return, 5) OVER w END AS label,
                 CASE h WHEN 1 THEN lead(split, 1) OVER w WHEN 2 THEN lead(split, 2) OVER w
                        WHEN 3 THEN lead(split, 3) OVER w WHEN 4 THEN lead(split, 4) OVER w
                        ELSE lead(split, 5) OVER w END AS there
          FROM ({_SPLIT_SQL}) s, (SELECT unnest(range(1, 6)) AS h)
          WINDOW w AS (PARTITION BY symbol, h ORDER BY date))
    WHERE label IS NOT NULL AND there = split"""


@query("model_rows", f"""
    SELECT symbol, {D('date', 'date')}, split, h, {R('label', 'label')} FROM ({_ROWS_SQL})""",
       ("v_bars", "v_sent"))
def q_model_rows(spark, sf):
    """Training, validation and test rows, without a label that lies in another split."""
    r = _model_rows(spark, sf).select("symbol", "date", "split", F.col("h").cast("bigint").alias("h"),
                                      "label")
    return report(r, round_cols=("label",), date_cols=("date",))


def _linear_sql(tail: str, sweeps: int = 400) -> str:
    """The linear family in SQL: correlations of the training rows, then every model by
    coordinate descent over them, one coordinate a step; ``tail`` follows with the tables
    ``r`` (rows) and ``model(model, intercept, b)``."""
    x = MO.LINEAR_FEATURES
    corr = lambda i, j: f"covar_pop({i}, {j}) / (stddev_pop({i}) * stddev_pop({j}))"
    a = ", ".join("[" + ", ".join(corr(i, j) for j in x) + "]" for i in x)
    pens = ", ".join(f"('{n}', {lam}, {alpha})" for n, (lam, alpha) in LI.PENALTIES.items())
    return f"""
    WITH RECURSIVE r AS MATERIALIZED ({_ROWS_SQL}),
    g AS MATERIALIZED (
      SELECT [{a}] AS a, [{", ".join(corr(i, "label") for i in x)}] AS c,
             [{", ".join(f"avg({i})" for i in x)}] AS m, [{", ".join(f"stddev_pop({i})" for i in x)}] AS s,
             avg(label) AS my, stddev_pop(label) AS sy
      FROM r WHERE split = 'train'),
    cd AS (
      SELECT model, lam::DOUBLE AS lam, alpha::DOUBLE AS alpha, 0 AS k, list_transform(m, lambda v: 0.0::DOUBLE) AS b
      FROM g, (VALUES {pens}) p(model, lam, alpha)
      UNION ALL
      SELECT model, lam, alpha, k + 1, list_transform(b, lambda v, i: CASE WHEN i = k % {len(x)} + 1 THEN
               sign(rho) * greatest(abs(rho) - lam * alpha, 0) / (1.0 + lam * (1 - alpha)) ELSE v END)
      FROM (SELECT cd.*, c[k % {len(x)} + 1] - list_dot_product(a[k % {len(x)} + 1], b) + b[k % {len(x)} + 1] AS rho
            FROM cd, g WHERE k < {sweeps * len(x)})),
    model AS MATERIALIZED (
      SELECT model, my - list_dot_product(w, m) AS intercept, w AS b
      FROM (SELECT model, m, my, list_transform(list_zip(b, s), lambda z: z[1] * sy / z[2]) AS w
            FROM cd, g WHERE k = {sweeps * len(x)}))
    {tail}"""


_X_SQL = f"[{', '.join(f'{c}::DOUBLE' for c in MO.LINEAR_FEATURES)}]"
_MODEL_METRICS_SQL = f"""
    SELECT model, split, count(*) AS n, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae,
           1 - sum(e * e) / (var_pop(label) * count(*)) AS r2,
           avg(CAST(sign(label) = sign(p) AS INTEGER)) AS accuracy
    FROM (SELECT *, p - label AS e FROM (
      SELECT model, split, label, intercept + list_dot_product(b, {_X_SQL}) AS p
      FROM r, model WHERE split <> 'train')) GROUP BY model, split"""
_METRICS = ("rmse", "mae", "r2", "accuracy")
_BEST_SQL = f"""(SELECT * FROM ({_MODEL_METRICS_SQL}) WHERE split = 'valid'
    ORDER BY accuracy DESC, rmse, model DESC LIMIT 1)"""


@query("linear_coefficients", _linear_sql(f"""
    SELECT model, f AS feature, {R('v', 'coefficient')} FROM (
      SELECT model, unnest(['intercept', {", ".join(f"'{c}'" for c in MO.LINEAR_FEATURES)}]) AS f,
             unnest(list_concat([intercept], b)) AS v FROM model)"""), ("v_bars", "v_sent"))
def q_linear_coefficients(spark, sf):
    """Coefficients of the four linear models, solved from one aggregate of the training rows."""
    rows = _model_rows(spark, sf)
    return report(LI.coefficients(MO.train_models(rows, tuple(LI.PENALTIES)), rows), round_cols=("coefficient",))


@query("train_models", _linear_sql(f"""
    SELECT model, split, n, {", ".join(R(c, c) for c in _METRICS)} FROM ({_MODEL_METRICS_SQL})"""),
       ("v_bars", "v_sent"))
def q_train_models(spark, sf):
    """The four linear return models fitted on the train split, scored on valid and test."""
    rows = _model_rows(spark, sf)
    return report(MO.evaluate(MO.train_models(rows, tuple(LI.PENALTIES)), rows), round_cols=_METRICS)


@query("train_models_scored", f"""
    SELECT m.model, s.split, s.n, true AS scored, true AS beats_noise
    FROM (VALUES {", ".join(f"('{m}')" for m in MO.MODEL_NAMES)}) m(model),
         (SELECT split, count(*) AS n FROM ({_ROWS_SQL}) WHERE split <> 'train' GROUP BY split) s""",
       ("v_bars", "v_sent"))
def q_train_models_scored(spark, sf):
    """All six models, trees included: each scores every validation and test row, with an error
    below twice the spread of the returns."""
    rows = _model_rows(spark, sf)
    met = MO.evaluate(MO.train_models(rows), rows)
    spread = rows.where("split <> 'train'").groupBy("split").agg(F.stddev_pop("label").alias("sd"))
    return met.join(spread, "split").select(
        "model", "split", F.col("n").cast("bigint").alias("n"),
        ((F.col("rmse") >= F.col("mae")) & F.col("accuracy").between(0, 1)).alias("scored"),
        (F.col("rmse") < 2 * F.col("sd")).alias("beats_noise"))


@query("select_best", _linear_sql(f"SELECT model, {R('rmse', 'rmse')}, {R('accuracy', 'accuracy')}, "
                                  f"{R('r2', 'r2')} FROM {_BEST_SQL}"), ("v_bars", "v_sent"))
def q_select_best(spark, sf):
    """The linear model of the highest directional accuracy on the validation split."""
    rows = _model_rows(spark, sf)
    best = MO.select_best(MO.evaluate(MO.train_models(rows, tuple(LI.PENALTIES)), rows))
    return report(best, round_cols=("rmse", "accuracy", "r2"))


def _forecasts(spark, sf, names):
    """Five days ahead by the best of the named models on the validation split, and its name."""
    f = _features(spark, sf)
    rows = MO.horizon_rows(FE.time_split(f))
    models = MO.train_models(rows, names)
    best = MO.select_best(MO.evaluate(models, rows)).first()["model"]
    last_close = f.groupBy("symbol").agg(F.max_by("close", "date").alias("last_close"))
    return MO.forecast(models[best], f, last_close, best), best


_FORECAST_SQL = f"""
    SELECT symbol AS ticker, date + h::INTEGER AS prediction_date, h, p AS predicted_return,
           close * exp(sum(ln(1 + p)) OVER (PARTITION BY symbol ORDER BY h)) AS predicted_price,
           model AS model_used
    FROM (SELECT symbol, date, h, close, best.model, intercept + list_dot_product(b, {_X_SQL}) AS p
          FROM (SELECT symbol, date, close, {_FILLED}, unnest(range(1, 6)) AS h
                FROM (SELECT f.*, c.close FROM ({_FEATURES_SQL}) f JOIN v_bars c USING (symbol, date)
                      QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)),
               {_BEST_SQL} best JOIN model ON model.model = best.model)"""
_PREDICTED = ("predicted_return", "predicted_price")


@query("forecast", _linear_sql(f"""
    SELECT ticker, {D('prediction_date', 'prediction_date')}, h::INTEGER AS h,
           {", ".join(R(c, c) for c in _PREDICTED)}, model_used FROM ({_FORECAST_SQL})"""), ("v_bars", "v_sent"))
def q_forecast(spark, sf):
    """Next five days per ticker by the best linear model: predicted daily return and compounded
    price."""
    p, _ = _forecasts(spark, sf, tuple(LI.PENALTIES))
    return report(p, round_cols=_PREDICTED, date_cols=("prediction_date",))


@query("forecast_identity", f"""
    SELECT symbol AS ticker, h, {D('last_date + h::INTEGER', 'prediction_date')}, true AS compounds,
           true AS best_model
    FROM (SELECT symbol, max(date) AS last_date FROM v_bars GROUP BY symbol),
         (SELECT unnest(range(1, 6)) AS h)""", ("v_bars",))
def q_forecast_identity(spark, sf):
    """The forecasts by the best of all six models: their keys, and per row whether the price
    compounds the predicted returns from the last close and the model is the one chosen."""
    p, best = _forecasts(spark, sf, MO.MODEL_NAMES)
    p = cut_lineage(p)
    w = Window.partitionBy("ticker").orderBy("h")
    last = fx.bars(spark, sf).groupBy(F.col("symbol").alias("ticker")).agg(
        F.max_by("close", "date").alias("last_close"))
    before = F.coalesce(F.lag("predicted_price").over(w), F.col("last_close"))
    p = p.join(last, "ticker").select(
        "ticker", F.col("h").cast("bigint").alias("h"), "prediction_date",
        (F.abs(F.col("predicted_price") / before - 1 - F.col("predicted_return")) < 1e-9).alias("compounds"),
        (F.col("model_used") == best).alias("best_model"))
    return report(p, date_cols=("prediction_date",))


_DET = "(v1 * v2 - c12 * c12)"


@query("per_ticker_training", f"""
    WITH r AS ({_ROWS_SQL}),
    g AS (SELECT symbol, count(*) AS n_train, avg(daily_return) AS m1, avg(volume_ratio) AS m2,
                 avg(label) AS my, var_pop(daily_return) AS v1, var_pop(volume_ratio) AS v2,
                 covar_pop(daily_return, volume_ratio) AS c12, covar_pop(daily_return, label) AS c1y,
                 covar_pop(volume_ratio, label) AS c2y
          FROM r WHERE split = 'train' GROUP BY symbol),
    b AS (SELECT *, (c1y * v2 - c2y * c12) / {_DET} AS b1, (c2y * v1 - c1y * c12) / {_DET} AS b2 FROM g),
    m AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM b)
    SELECT m.symbol, n_train, {R('b0', 'b0')}, {R('b1', 'b1')}, {R('b2', 'b2')}, 'ok' AS status,
           count(*) AS n_eval,
           {R('sqrt(avg((b0 + b1 * daily_return + b2 * volume_ratio - label) ** 2))', 'rmse')}
    FROM m JOIN r ON r.symbol = m.symbol AND r.split <> 'train'
    GROUP BY ALL""", ("v_bars", "v_sent"))
def q_per_ticker_training(spark, sf):
    return report(MO.per_ticker_ols(_model_rows(spark, sf)), round_cols=("b0", "b1", "b2", "rmse"))


@query("store_forecast", _linear_sql(f"""
    SELECT ticker, {D('prediction_date', 'prediction_date')}, {", ".join(R(c, c) for c in _PREDICTED)},
           model_used, {TS("TIMESTAMP '2024-01-01'", 'created_at')}, {TS("TIMESTAMP '2024-01-02'", 'updated_at')},
           'update' AS action FROM ({_FORECAST_SQL})"""), ("v_bars", "v_sent"))
def q_store_forecast(spark, sf):
    """Forecasts upserted into the stored forecast table, keyed (ticker, prediction_date), with
    the model that made them: a first run inserts, a second run over the same keys updates."""
    f, _ = _forecasts(spark, sf, tuple(LI.PENALTIES))
    keys = ["ticker", "prediction_date"]
    first = TB.upsert_merge(f.limit(0).drop("h"), f, keys, ["h"], "2024-01-01 00:00:00", with_action=False)
    second = TB.upsert_merge(first, f, keys, ["h"], "2024-01-02 00:00:00")
    return report(second, round_cols=_PREDICTED, date_cols=("prediction_date",), ts_cols=("created_at", "updated_at"))


@query("store_forecast_keys", f"""
    SELECT symbol AS ticker, {D('last_date + h::INTEGER', 'prediction_date')}, 'update' AS action,
           true AS has_model
    FROM (SELECT symbol, max(date) AS last_date FROM v_bars GROUP BY symbol),
         (SELECT unnest(range(1, 6)) AS h)""", ("v_bars",))
def q_store_forecast_keys(spark, sf):
    """Keys and actions of the second run of ``store_forecast``."""
    return q_store_forecast(spark, sf).select("ticker", "prediction_date", "action",
                                              F.col("model_used").isNotNull().alias("has_model"))
