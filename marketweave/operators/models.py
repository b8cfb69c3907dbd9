"""Return models and forecasts (declared by the reference, built here).

One pooled model per algorithm over all tickers, trained on a direct multi-horizon design: each
(ticker, day, h) row predicts the daily return ``h`` days ahead from features known at the
day, ``h`` being a feature. The linear family is solved from Gram statistics (``linear``), the
tree models are MLlib's, with the ticker one-hot encoded; their training set is checkpointed
into the shared checkpoint folder before fitting, so iterative fits do not recompute the
feature lineage and survive executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketweave.operators import linear as LI
from marketweave.operators.analytics import regression_metrics
from marketweave.session import cut_lineage

FEATURES = ("daily_return", "volatility_lag1", "range_lag1", "volume_ratio",
            "sentiment_score", "sentiment_momentum")
MAX_HORIZON = 5


def _estimator(name: str):
    if name == "random_forest":
        return RandomForestRegressor(numTrees=12, maxDepth=5, seed=42)
    if name == "gbt":
        return GBTRegressor(maxIter=12, maxDepth=3, seed=42, checkpointInterval=5)
    raise ValueError(f"unknown model {name}")


TREES = ("random_forest", "gbt")
MODEL_NAMES = (*LI.PENALTIES, *TREES)
LINEAR_FEATURES = (*FEATURES, "h")


def horizon_rows(features: DataFrame, by: str = "symbol", order: str = "date",
                 max_h: int = MAX_HORIZON, with_target: bool = True,
                 split_col: str = "split") -> DataFrame:
    """(ticker, day, h) rows; the target is the daily return ``h`` days ahead. Feature
    nulls (start of history) are filled with 0. Where the days are split, a row whose target
    lies in another split than its day is left out, so no label of the training rows reaches
    into the validation or test period."""
    w = Window.partitionBy(by).orderBy(order)
    base = features
    if with_target:
        ahead = []
        for h in range(1, max_h + 1):
            label = F.lead("daily_return", h).over(w)
            if split_col in features.columns:
                label = F.when(F.lead(split_col, h).over(w) == F.col(split_col), label)
            ahead.append(label)
        base = base.withColumn("_targets", F.array(*ahead))
    base = base.na.fill(0.0, subset=[c for c in FEATURES if c in features.columns])
    if with_target:
        e = base.select("*", F.posexplode("_targets").alias("_i", "label")).drop("_targets")
        e = e.where(F.col("label").isNotNull())
    else:
        e = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_h - 1))).alias("_i"))
    return e.withColumn("h", (F.col("_i") + 1).cast("double")).drop("_i")


def feature_stages(by: str = "symbol") -> Pipeline:
    """Ticker one-hot + standardised numeric features (statistics fitted on train)."""
    idx = StringIndexer(inputCol=by, outputCol="_sym_idx", handleInvalid="keep")
    ohe = OneHotEncoder(inputCols=["_sym_idx"], outputCols=["_sym_vec"])
    asm = VectorAssembler(inputCols=[*FEATURES, "h"], outputCol="_raw", handleInvalid="skip")
    sc = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True)
    asm2 = VectorAssembler(inputCols=["_scaled", "_sym_vec"], outputCol="features")
    return Pipeline(stages=[idx, ohe, asm, sc, asm2])


def model_stages(name: str, by: str = "symbol") -> Pipeline:
    return Pipeline(stages=[*feature_stages(by).getStages(), _estimator(name)])


def train_models(rows: DataFrame, names: Sequence[str] = MODEL_NAMES,
                 split_col: str = "split") -> dict[str, LI.LinearModel | PipelineModel]:
    """Fit every named model on the train split. One aggregate serves all linear models. For the
    trees the rows are checkpointed before any fit, the feature stages (indexer, scaler —
    statistics from train only) are fitted once, and every estimator fits on the assembled
    training vectors."""
    train = rows.where(F.col(split_col) == "train").select("symbol", *FEATURES, "h", "label")
    out: dict[str, LI.LinearModel | PipelineModel] = {}
    trees = [n for n in names if n not in LI.PENALTIES]
    if trees:
        train = cut_lineage(train)
    if len(trees) < len(names):
        g = LI.gram(train, LINEAR_FEATURES)
        out |= {n: LI.fit(g, LINEAR_FEATURES, n) for n in names if n in LI.PENALTIES}
    if trees:
        feats = feature_stages().fit(train)
        vectors = cut_lineage(feats.transform(train).select("features", "label"))
        out |= {n: PipelineModel(stages=[*feats.stages, _estimator(n).fit(vectors)]) for n in trees}
    return {n: out[n] for n in names}


def evaluate(models: dict[str, LI.LinearModel | PipelineModel], rows: DataFrame, split_col: str = "split"
             ) -> DataFrame:
    """RMSE, MAE, R², directional accuracy and row count per model and split (valid/test), in one
    pass: linear models are expressions of the rows, the trees' feature stages run once."""
    scored = rows.where(F.col(split_col) != "train")
    trees = [m for m in models.values() if isinstance(m, PipelineModel)]
    if trees:
        scored = PipelineModel(stages=trees[0].stages[:-1]).transform(scored)
    kept = [split_col, "label", *(["features"] if trees else [])]
    scored = scored.select(*kept, *[m.prediction().alias(f"_p{i}") for i, m in enumerate(models.values())
                                    if isinstance(m, LI.LinearModel)])
    for i, m in enumerate(models.values()):
        if isinstance(m, PipelineModel):
            scored = m.stages[-1].copy().setPredictionCol(f"_p{i}").transform(scored)
    each = F.explode(F.array(*[
        F.struct(F.lit(n).alias("model"), F.col(f"_p{i}").alias("predicted_return"))
        for i, n in enumerate(models)])).alias("_e")
    p = scored.select(split_col, F.col("label").alias("actual_return"), each).select(
        "_e.model", split_col, "actual_return", "_e.predicted_return")
    return regression_metrics(p, by=("model", split_col), actual="actual_return",
                              predicted="predicted_return")


def select_best(metrics: DataFrame, split: str = "valid", by: str = "accuracy") -> DataFrame:
    """Best model on a split: highest directional accuracy (or lowest rmse), ties to the
    lower rmse, then the model name."""
    m = metrics.where(F.col("split") == split)
    if by == "rmse":
        key = F.struct(-F.col("rmse"), F.lit(0.0), F.col("model"))
    else:
        key = F.struct(F.col(by), -F.col("rmse"), F.col("model"))
    return m.agg(F.max_by(F.struct("model", "rmse", "accuracy", "r2"), key).alias("b")) \
        .select("b.*")


def forecast(model: LI.LinearModel | PipelineModel, features: DataFrame, last_close: DataFrame,
             model_name: str, by: str = "symbol", order: str = "date",
             max_h: int = MAX_HORIZON) -> DataFrame:
    """Next ``max_h`` days per ticker from its latest feature row: predicted daily return
    per horizon and the compounded price ``close * exp(sum(log1p(r)))``."""
    latest = features.groupBy(by).agg(F.max_by(F.struct(*features.columns), order).alias("r")) \
        .select("r.*")
    rows = horizon_rows(latest, by, order, max_h, with_target=False)
    p = model.transform(rows).select(by, order, "h", F.col("prediction").alias("predicted_return"))
    w = Window.partitionBy(by).orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    p = p.join(last_close, by).withColumn(
        "predicted_price",
        F.col("last_close") * F.exp(F.sum(F.log1p("predicted_return")).over(w)))
    return p.select(
        F.col(by).alias("ticker"),
        F.date_add(F.col(order), F.col("h").cast("int")).alias("prediction_date"),
        F.col("h").cast("int").alias("h"), "predicted_return", "predicted_price",
        F.lit(model_name).alias("model_used"))


TICKER_FEATURES = ("daily_return", "volume_ratio")
MIN_TRAIN_ROWS = 10


def per_ticker_ols(rows: DataFrame, by: str = "symbol", split_col: str = "split",
                   x: tuple[str, str] = TICKER_FEATURES) -> DataFrame:
    """One ordinary-least-squares model per ticker, label on two features, solved from the
    variances and covariances that one grouped aggregate gives (map-side partial sums; a
    ticker's rows never meet in one task). A ticker without enough rows or with features
    that do not vary apart has a status instead of a model; the others are unaffected."""
    x1, x2 = x
    train = F.col(split_col) == "train"
    on = lambda c: F.when(train, F.col(c))
    g = rows.groupBy(by).agg(
        F.count(on("label")).alias("n_train"),
        F.avg(on(x1)).alias("m1"), F.avg(on(x2)).alias("m2"), F.avg(on("label")).alias("my"),
        F.var_pop(on(x1)).alias("v1"), F.var_pop(on(x2)).alias("v2"),
        F.covar_pop(on(x1), on(x2)).alias("c12"), F.covar_pop(on(x1), on("label")).alias("c1y"),
        F.covar_pop(on(x2), on("label")).alias("c2y"))
    det = F.col("v1") * F.col("v2") - F.col("c12") * F.col("c12")
    ok = (F.col("n_train") >= MIN_TRAIN_ROWS) & (det > 1e-12 * F.col("v1") * F.col("v2"))
    b1 = F.try_divide(F.col("c1y") * F.col("v2") - F.col("c2y") * F.col("c12"), det)
    b2 = F.try_divide(F.col("c2y") * F.col("v1") - F.col("c1y") * F.col("c12"), det)
    model = (g.withColumns({"b1": F.when(ok, b1), "b2": F.when(ok, b2)})
             .withColumn("b0", F.col("my") - F.col("b1") * F.col("m1") - F.col("b2") * F.col("m2"))
             .withColumn("status", F.when(ok, "ok").when(F.col("n_train") < MIN_TRAIN_ROWS, "too few rows")
                         .otherwise("singular"))
             .select(F.col(by).alias("_by"), "n_train", "b0", "b1", "b2", "status"))
    err = F.col("b0") + F.col("b1") * F.col(x1) + F.col("b2") * F.col(x2) - F.col("label")
    # the few rows of a ticker's model travel to its rows, which are aggregated where they are
    return (rows.join(model, F.col(by) == F.col("_by"))
            .groupBy(by, "n_train", "b0", "b1", "b2", "status")
            .agg(F.count_if(~train).alias("n_eval"),
                 F.sqrt(F.avg(F.when(~train, err * err))).alias("rmse")))
