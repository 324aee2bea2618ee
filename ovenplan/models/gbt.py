"""Gradient-boosted demand models with Spark ML.

Three feature sets (baseline, v2, v3) over one training frame. Product,
warehouse, series and category keys enter as means over earlier days. Trees are
built one at a time from the margin of the earlier ones
(:mod:`ovenplan.models.boosting`): errors on the stopping set are known after each, the
patience ends the run, and the best first trees are the model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.models import boosting
from ovenplan.operators import dimension, exogenous, series, series_state
from ovenplan.operators.evaluation import predictions, regression_metrics
from ovenplan.operators.forecast import DAYS_BACK, active_series

#: The groups whose trailing means stand for their keys.
KEY_GROUPS = {
    "product": ["product_key"],
    "warehouse": ["warehouse_key"],
    "series": ["product_key", "warehouse_key"],
    "category": ["category"],
}


@dataclass(frozen=True)
class FeatureSet:
    name: str
    groups: list[str]
    numeric: list[str]
    log_target: bool = False
    max_iter: int = 500
    depth: int = 6
    step_size: float = 0.05
    patience: int = 50
    l2: float = 0.0

    @property
    def features(self) -> list[str]:
        return [f"{g}_mean" for g in self.groups] + self.numeric


# The three model configurations (labels, feature lists, trees
# at most, depth, learning rate, patience, L2 penalty of leaf values).
CALENDAR = ["day_of_week", "month", "day_of_year", "is_weekend", "is_holiday"]
CALENDAR_ISO = ["day_of_week", "month", "day_of_year", "week_of_year", "is_weekend", "is_holiday"]
CYCLIC = ["dow_sin", "dow_cos", "month_sin", "month_cos", "doy_sin", "doy_cos"]
BASELINE = FeatureSet("baseline_calendar", ["product", "warehouse", "series"], CALENDAR, max_iter=500, depth=6, patience=50)
V2 = FeatureSet(
    "v2_full_features",
    ["product", "warehouse", "series"],
    CALENDAR_ISO
    + ["temperature", "precipitation", "avg_price", "lag_7", "lag_14", "lag_30", "ma_7", "ma_14", "ma_30", "std_7"],
    max_iter=1000,
    depth=6,
    patience=50,
)
V3 = FeatureSet(
    "v3_log_ewma_cat",
    ["product", "warehouse", "series", "category"],
    CALENDAR_ISO
    + CYCLIC
    + ["temperature", "precipitation", "avg_price", "lag_1", "lag_7", "lag_14", "lag_30"]
    + ["ma_7", "ma_14", "ma_30", "ewma_7", "ewma_14", "std_7", "trend_7_30"],
    log_target=True,
    max_iter=1500,
    depth=7,
    patience=100,
    l2=3.0,
)

FEATURE_SETS = {fs.name: fs for fs in (BASELINE, V2, V3)}
ABOUT = "model string, iterations int, l2 boolean"
LEAVES = "tree int, leaf_values array<double>"


def training_frame(
    daily: DataFrame,
    weather: DataFrame,
    holidays: DataFrame | None,
    nomenclature: DataFrame | None,
    leaky_price: bool = False,
    fit_before=None,
) -> DataFrame:
    """All columns any feature set uses, one row per rollup row.

    ``avg_price`` is the trailing price (previous rows only) unless
    ``leaky_price``: then it is the same-row ``amount / quantity``, which
    reads the label. Missing temperatures become the median over the rows
    before ``fit_before`` (the training rows; None: all rows).
    """
    # Keys enter as what was sold under them on earlier days: no index of all
    # keys on the driver, and bins that do not grow with their number.
    # Their means are joined to the narrow rollup: from one row per product and
    # day, category and day, warehouse and day. The series' own comes from its window.
    narrow = daily.select("date", "product_key", "product_name", "warehouse_key", "quantity", "amount")
    df = dimension.with_category(narrow, nomenclature)
    for name, keys in KEY_GROUPS.items():
        if name != "series":
            df = series.with_trailing_mean(df, f"{name}_mean", keys)
    # One shuffle of rows with these few columns; the enrichment after the windows
    # is row-wise projections and broadcast joins of calendar-bounded tables.
    df = series.with_series_features(
        df,
        lags=(1, 7, 14, 30),
        moving_avgs=(7, 14, 30),
        std_window=7,
        ewma_spans=(7, 14),
        trend=(7, 30),
        trailing_price=not leaky_price,
        trailing_mean="series_mean",
    )
    df = exogenous.with_calendar(df, holidays, iso_week=True, cyclic=True)
    df = exogenous.with_weather(df, weather, median_before=fit_before)
    if leaky_price:
        df = df.withColumn("avg_price", F.when(F.col("quantity") > 0, F.col("amount") / F.col("quantity")).otherwise(0.0))
    else:
        df = df.withColumnRenamed("trailing_price", "avg_price")
    return df.withColumn("log_target", F.log1p("quantity"))


def serving_frame(
    daily: DataFrame,
    weather: DataFrame,
    holidays: DataFrame | None,
    nomenclature: DataFrame | None,
    target,
    days_back: int = DAYS_BACK,
    fit_before=None,
) -> DataFrame:
    """Every feature set's columns for ``target``, one row per series active in the ``days_back`` days before.

    The rows to predict are added to the rollup of the days before, without a
    quantity, and go through :func:`training_frame`: each feature has the
    definition it was trained with. Pass the ``fit_before`` of the training.
    """
    day = F.lit(target).cast("date")
    past = daily.where(F.col("date") < day)
    rows = active_series(past.where(F.col("date") >= F.date_sub(day, days_back))).withColumn("date", day)
    both = past.unionByName(rows, allowMissingColumns=True)
    frame = training_frame(both, weather, holidays, nomenclature, fit_before=fit_before)
    return frame.where(F.col("date") == day).drop("quantity", "amount", "product_name", "log_target")


def temperature_fill(daily: DataFrame, weather: DataFrame, fit_before) -> float | None:
    """What missing temperatures become in the training frame with this ``fit_before``."""
    rows = daily.where(F.col("date") < F.lit(fit_before).cast("date"))
    w = exogenous.one_per_day(weather.select("date", "temperature"))
    return rows.sparkSession.range(1).select(exogenous.row_weighted_median(rows, w, "temperature").alias("t")).first().t


def serving_frame_from_state(
    state: DataFrame,
    weather: DataFrame,
    holidays: DataFrame | None,
    nomenclature: DataFrame | None,
    target,
    fill: float | None,
    days_back: int = DAYS_BACK,
) -> DataFrame:
    """:func:`serving_frame` from the series' state of the day before ``target``: no history is read.

    ``fill`` stands in for a missing temperature (:func:`temperature_fill`). The
    rollup's quantities are positive, so a series is active if its last row is recent.
    """
    day = F.lit(target).cast("date")
    known = dimension.with_category(state, nomenclature)
    rows = known.where(F.col("last_date") >= F.date_sub(day, days_back)).withColumn("date", day)
    rows = rows.select("date", "product_key", "warehouse_key", "category", *series_state.feature_columns())
    rows = exogenous.with_calendar(rows, holidays, iso_week=True, cyclic=True)
    rows = exogenous.with_weather(rows, weather, fill_median=False)
    rows = rows.withColumn("temperature", F.coalesce("temperature", F.lit(fill).cast("double")))
    for name, keys in KEY_GROUPS.items():
        total = known.groupBy(*keys).agg((F.sum("quantity_sum") / F.sum("n")).alias(f"{name}_mean"))
        rows = rows.join(total, keys)
    return rows.withColumnRenamed("trailing_price", "avg_price")


def _labelled(df: DataFrame, fs: FeatureSet) -> DataFrame:
    label = F.col("log_target") if fs.log_target else F.col("quantity")
    return df.withColumn("label", label.cast("double"))


def best_iteration(errors: list[float], patience: int) -> int:
    """1-based iteration with the lowest error, stopping after ``patience`` rounds without a new best."""
    best, best_i = float("inf"), 0
    for i, e in enumerate(errors):
        if e < best:
            best, best_i = e, i
        elif i - best_i >= patience:
            break
    return best_i + 1


@dataclass
class FittedModel:
    feature_set: FeatureSet
    model: PipelineModel
    iterations: int
    stop_errors: list[float]
    #: With an L2 penalty: of each tree the weighted values of its leaves, by leaf id.
    leaves: list[list[float]] | None = None

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Predictions in units: ``expm1`` and clamp at 0 for log-target models."""
        scored = self.model.transform(df)
        p = F.col("prediction")
        if self.leaves is not None:
            p = boosting.leaf_prediction(self.leaves)
        if self.feature_set.log_target:
            p = F.greatest(F.expm1(p), F.lit(0.0))
        cols = [c for c in scored.columns if c not in ("features", "leaves", "prediction", "label")]
        return scored.select(*cols, p.alias(output))

    def feature_importance(self, spark) -> DataFrame:
        names = self.feature_set.features
        # The vector ends at the last feature that a tree splits on.
        imp = self.model.stages[-1].featureImportances.toArray().tolist()
        rows = [(n, float(v) * 100.0) for n, v in zip(names, imp + [0.0] * (len(names) - len(imp)))]
        df = spark.createDataFrame(rows, "feature string, importance double")
        return df.orderBy(F.col("importance").desc(), "feature")


def fit(
    train: DataFrame,
    stop: DataFrame | None,
    fs: FeatureSet,
    max_iter: int | None = None,
    max_bins: int = 256,
    seed: int = 42,
) -> FittedModel:
    """Fit at most ``max_iter`` trees, stopping early on ``stop`` (all of them when ``stop`` is None)."""
    assembler = VectorAssembler(inputCols=fs.features, outputCol="features", handleInvalid="keep")
    ensemble, errors = boosting.boost(
        assembler.transform(_labelled(train, fs)),
        None if stop is None else assembler.transform(_labelled(stop, fs)),
        max_iter or fs.max_iter,
        fs.patience,
        best_iteration,
        l2=fs.l2,
        step_size=fs.step_size,
        maxDepth=fs.depth,
        maxBins=max_bins,
        seed=seed,
    )
    model = PipelineModel(stages=[assembler, ensemble.model().setLeafCol("leaves")])
    return FittedModel(fs, model, len(ensemble.trees), errors, ensemble.weighted_leaves())


def evaluate(fitted: FittedModel, test: DataFrame) -> DataFrame:
    """One row: model, iterations, n, mae, rmse, r2, mape on ``test``."""
    scored = fitted.predict(test, "predicted")
    m = regression_metrics(scored, "quantity", "predicted")
    return m.select(
        F.lit(fitted.feature_set.name).alias("model"), F.lit(fitted.iterations).alias("iterations"), "*"
    )


def metrics_row(fitted: FittedModel, test: DataFrame, seq: int) -> DataFrame:
    """The row of the metrics log (``schemas.METRICS``) for a model on ``test``; ``seq`` numbers the training runs."""
    features = F.lit(",".join(fitted.feature_set.features)).alias("features")
    return evaluate(fitted, test).select(
        F.lit(seq).cast("long").alias("seq"), "model", "mae", "rmse", "mape", "r2", features
    )


def validation_predictions(fitted: FittedModel, test: DataFrame) -> DataFrame:
    return predictions(fitted.predict(test, "_p"), "_p")


def save(fitted: FittedModel, path: str) -> None:
    """The pipeline with, beside its stages, its feature set's name, number of trees and leaf values."""
    fitted.model.write().overwrite().save(path)
    spark = SparkSession.active()
    about = [(fitted.feature_set.name, fitted.iterations, fitted.leaves is not None)]
    spark.createDataFrame(about, ABOUT).coalesce(1).write.json(f"{path}/about")
    if fitted.leaves is not None:
        spark.createDataFrame(list(enumerate(fitted.leaves)), LEAVES).coalesce(1).write.parquet(f"{path}/leaves")


def load(path: str, fs: FeatureSet | None = None) -> FittedModel:
    """A saved model; ``fs`` is needed only for a feature set that is not one of ``FEATURE_SETS``."""
    spark = SparkSession.active()
    about, leaves = spark.read.schema(ABOUT).json(f"{path}/about").first(), None
    if about.l2:
        # At most one row per tree.
        leaves = [r.leaf_values for r in sorted(spark.read.schema(LEAVES).parquet(f"{path}/leaves").collect())]
    return FittedModel(fs or FEATURE_SETS[about.model], PipelineModel.load(path), about.iterations, [], leaves)
