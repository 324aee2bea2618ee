"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Each callable builds its inputs from the test tables through
:mod:`ovenplan.sources.testdata` and composes library operators. Column
names match :mod:`ovenplan.plans.oracle`. Floating results whose last bits
depend on the summation algorithm (standard deviations, EWMA, logs, sines,
error metrics) are reported rounded half to even to a fixed number of
digits, in the query and in its SQL alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.functions import guarded_ratio, round_half_even
from ovenplan.models import gbt
from ovenplan.operators import dimension, evaluation, exogenous, forecast, reports, rollup, series, series_state
from ovenplan.schemas import METRICS, PREDICTIONS, SALES
from ovenplan.session import materialize, shared_dir
from ovenplan.sources import files, landing, payloads, sinks
from ovenplan.sources import testdata as td
from ovenplan.streaming import ingest, rollup_view

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries (test calendar: 1992 .. 2001-11-04).
RANGE_FROM, RANGE_TO = "1996-01-01", "1998-12-31"
CUTOFF = "2001-01-01"
STOP_CUTOFF = "2000-07-01"
TARGET = "2001-11-05"
EXTEND_DAYS = 14
STATE_CUTOFF = dt.date(2001, 10, 26)
GAP_FROM, GAP_TO = "1997-03-01", "1997-04-01"

KEYS = ["date", "product_key", "warehouse_key"]


def r(c: Column | str, digits: int) -> Column:
    return round_half_even(c, digits)


class Inputs:
    """The test tables seen as the planning model, for one (spark, sf_dir).

    One instance per query call; each frame is built once per instance, so a
    query that uses the rollup in several places shares one plan object.
    """

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    @cached_property
    def sales(self) -> DataFrame:
        return td.sales(self.spark, self.sf)

    @cached_property
    def nomenclature(self) -> DataFrame:
        return td.nomenclature(self.spark, self.sf)

    @cached_property
    def weather(self) -> DataFrame:
        return td.weather_daily(self.spark, self.sf)

    @cached_property
    def holidays(self) -> DataFrame:
        return td.holidays(self.spark, self.sf)

    @cached_property
    def daily(self) -> DataFrame:
        return rollup.daily_rollup(self.sales, self.nomenclature)

    @cached_property
    def daily_table(self) -> DataFrame:
        """The rollup written once to the shared folder, for queries that read it in several passes."""
        return materialize(self.daily, "daily")


# ---- sources, rollup, data quality -------------------------------------------------


def q_scan_sales(spark, sf):
    return files.conform(Inputs(spark, sf).sales, SALES)


def q_sales_in_range(spark, sf):
    return files.sales_in_range(Inputs(spark, sf).sales, RANGE_FROM, RANGE_TO)


def q_sales_named(spark, sf):
    i = Inputs(spark, sf)
    named = dimension.with_product_name(i.sales, i.nomenclature)
    return named.select("period", "product_key", "product_name", "warehouse_key", "quantity", "amount")


def q_daily_rollup(spark, sf):
    return Inputs(spark, sf).daily


def q_daily_rollup_no_dim(spark, sf):
    return rollup.daily_rollup(Inputs(spark, sf).sales, None)


def q_rollup_audit(spark, sf):
    return rollup.rollup_audit(Inputs(spark, sf).sales)


def q_dq_missing_counts(spark, sf):
    """One pass over the records: the grouped table feeds both counts."""
    i = Inputs(spark, sf)
    groups = materialize(rollup.daily_groups(i.sales), "daily_groups")
    daily = rollup.name_rollup(rollup.keyed_groups(groups), i.nomenclature)
    no_temp = exogenous.rows_without_temperature(daily, i.weather)
    return rollup.unnamed_records(groups, i.nomenclature).select(
        "sales_without_name", no_temp.select("rows_without_temperature").scalar().alias("daily_without_temperature")
    )


# ---- enrichment ----------------------------------------------------------------------


def q_calendar_features(spark, sf):
    i = Inputs(spark, sf)
    df = exogenous.with_calendar(i.daily, i.holidays, iso_week=True)
    return df.select(*KEYS, "quantity", "day_of_week", "month", "day_of_year", "week_of_year", "is_weekend", "is_holiday")


def q_cyclic_features(spark, sf):
    i = Inputs(spark, sf)
    df = exogenous.with_calendar(i.daily, None, iso_week=False, cyclic=True)
    cyc = ["dow_sin", "dow_cos", "month_sin", "month_cos", "doy_sin", "doy_cos"]
    return df.select(*KEYS, *[r(c, 9).alias(c) for c in cyc])


def q_weather_join_median_fill(spark, sf):
    i = Inputs(spark, sf)
    # Two passes over the rollup (the median, then the fill): read it from the written table.
    return exogenous.with_weather(i.daily_table, i.weather).select(*KEYS, "quantity", "temperature", "precipitation")


def q_product_category(spark, sf):
    i = Inputs(spark, sf)
    return dimension.with_category(i.daily, i.nomenclature).select(*KEYS, "product_name", "category")


def q_unit_price(spark, sf):
    d = Inputs(spark, sf).daily
    return d.select(*KEYS, "quantity", "amount", guarded_ratio("amount", "quantity").alias("avg_price"))


# ---- series windows ------------------------------------------------------------------


def _series(spark, sf, **kw) -> DataFrame:
    defaults = dict(lags=(), moving_avgs=(), std_window=None, ewma_spans=(), trend=None)
    defaults.update(kw)
    return series.with_series_features(Inputs(spark, sf).daily, **defaults)


def q_series_lags(spark, sf):
    return _series(spark, sf, lags=(1, 7, 14, 30)).select(*KEYS, "quantity", "lag_1", "lag_7", "lag_14", "lag_30")


def q_series_moving_avg(spark, sf):
    return _series(spark, sf, moving_avgs=(7, 14, 30)).select(*KEYS, "quantity", "ma_7", "ma_14", "ma_30")


def q_series_volatility(spark, sf):
    return _series(spark, sf, std_window=7).select(*KEYS, "quantity", r("std_7", 9).alias("std_7"))


def q_series_ewma(spark, sf):
    df = _series(spark, sf, ewma_spans=(7, 14))
    return df.select(*KEYS, "quantity", r("ewma_7", 6).alias("ewma_7"), r("ewma_14", 6).alias("ewma_14"))


def q_series_trend(spark, sf):
    return _series(spark, sf, trend=(7, 30)).select(*KEYS, "quantity", "trend_7_30")


def q_series_calendar_lags(spark, sf):
    df = series.with_calendar_features(Inputs(spark, sf).daily, lags=(1, 7, 14, 30))
    names = ["lag_1", "lag_7", "lag_14", "lag_30", "ma_7", "ma_14", "ma_30"]
    return df.select(*KEYS, "quantity", *names, r("std_7", 9).alias("std_7"))


def q_series_features_incremental(spark, sf):
    """The state of the days before ``STATE_CUTOFF``, then day by day: every series feature of the days from it on."""
    i = Inputs(spark, sf)
    path = shared_dir(spark, "series-state")
    series_state.start(spark, path, i.daily_table, STATE_CUTOFF)
    _, found = series_state.advance(spark, path, i.daily_table, dt.date.fromisoformat(TARGET))
    digits = {"std_7": 9, "ewma_7": 6, "ewma_14": 6}
    names = ["lag_1", "lag_7", "lag_14", "lag_30", "ma_7", "ma_14", "ma_30", "std_7", "ewma_7", "ewma_14", "trend_7_30"]
    return found.select(*KEYS, "quantity", *[r(c, digits[c]).alias(c) if c in digits else c for c in names])


# ---- reports -------------------------------------------------------------------------


def q_daily_totals(spark, sf):
    return reports.daily_totals(Inputs(spark, sf).daily)


def q_daily_totals_ma7(spark, sf):
    return reports.daily_totals_ma7(Inputs(spark, sf).daily_table, 7)


def q_top_products_by_amount(spark, sf):
    return reports.top_products(Inputs(spark, sf).daily, "amount", 20)


def q_top_products_by_quantity(spark, sf):
    return reports.top_products(Inputs(spark, sf).daily, "quantity", 15)


def q_weekday_totals(spark, sf):
    return reports.weekday_totals(Inputs(spark, sf).daily)


def q_monthly_totals(spark, sf):
    return reports.monthly_totals(Inputs(spark, sf).daily)


def q_top_product_month_matrix(spark, sf):
    return reports.product_month_long(Inputs(spark, sf).daily_table, 10)


def q_product_summary(spark, sf):
    return reports.product_summary(Inputs(spark, sf).daily)


def q_kpis(spark, sf):
    return reports.kpis(Inputs(spark, sf).daily)


# ---- splits, metrics, validation (naive forecasts: no model needed) ----------------------


def _split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("quantity").alias("quantity"),
    )


def q_split_counts(spark, sf):
    return _split_summary(evaluation.split_label(Inputs(spark, sf).daily, CUTOFF))


def q_ordered_split_counts(spark, sf):
    return _split_summary(evaluation.ordered_split(Inputs(spark, sf).daily_table, 0.2))


def q_log_target(spark, sf):
    d = Inputs(spark, sf).daily
    lt = F.log1p("quantity")
    return d.select(*KEYS, "quantity", r(lt, 9).alias("log_target"), r(F.expm1(lt), 6).alias("back_transformed"))


def _naive(spark, sf) -> DataFrame:
    """Validation rows with naive forecasts (previous-rows features)."""
    feats = series.with_series_features(
        Inputs(spark, sf).daily, lags=(7,), moving_avgs=(7, 30), std_window=None, ewma_spans=(7,)
    )
    return evaluation.time_split(feats, CUTOFF)[1]


NAIVE_MODELS = {"naive_lag_7": "lag_7", "naive_ma_7": "ma_7", "naive_ma_30": "ma_30", "naive_ewma_7": "ewma_7"}


def _naive_metrics(val: DataFrame, models: dict[str, str]) -> DataFrame:
    m = evaluation.regression_metrics_many(val, models)
    seq = F.array_position(F.array(*[F.lit(k) for k in models]), F.col("model"))
    return m.select(seq.cast("long").alias("seq"), "model", *[r(c, 6).alias(c) for c in ("mae", "rmse", "r2", "mape")], "n")


def q_regression_metrics(spark, sf):
    return _naive_metrics(_naive(spark, sf), {"naive_lag_7": "lag_7"})


def q_model_comparison(spark, sf):
    """The first three naive models are the log; the EWMA one is compared with them."""
    # One pass computes all four models' metrics; the 4-row result is written
    # once because the log and the current row are both read from it.
    metrics = materialize(_naive_metrics(_naive(spark, sf), NAIVE_MODELS), "naive_metrics")
    log = metrics.where(F.col("seq") < 4)
    current = metrics.where(F.col("seq") == 4)
    out = evaluation.compare_to_log(log, current)
    return out.select(*[r(c, 6).alias(c) if c in ("delta", "delta_vs_first", "pct_vs_first") else c for c in out.columns])


def _predictions(spark, sf) -> DataFrame:
    return evaluation.predictions(_naive(spark, sf), "ma_7")


def q_validation_overall(spark, sf):
    v = evaluation.validation_overall(_predictions(spark, sf))
    return v.select(*[r(c, 6).alias(c) if c in ("mae", "diff_pct") else c for c in v.columns])


def q_validation_by_product(spark, sf):
    return evaluation.validation_by_product(_predictions(spark, sf))


def q_validation_from_csv(spark, sf):
    """The predictions written as CSV by one job and validated from the file by another."""
    path = shared_dir(spark, "predictions")
    sinks.write_csv_report(_predictions(spark, sf), path)
    lines = files.read_csv_checked(spark, path, PREDICTIONS)
    return evaluation.validation_by_product(files.accepted(lines))


def q_metrics_log(spark, sf):
    """Each naive model's run appended to a log, the first two twice: one row each."""
    path = shared_dir(spark, "metrics-log")
    metrics = materialize(_naive_metrics(_naive(spark, sf), NAIVE_MODELS), "naive_metrics")
    rows = files.conform(metrics.withColumn("features", F.lit("quantity")), METRICS)
    for runs in ([1], [2], [1, 2], [3, 4]):
        sinks.append_metrics(rows.where(F.col("seq").isin(runs)), path)
    return sinks.read_metrics(spark, path)


def q_validation_by_day(spark, sf):
    return evaluation.validation_by_day(_predictions(spark, sf))


def q_validation_daily_accuracy(spark, sf):
    a = evaluation.validation_daily_accuracy(evaluation.validation_by_day(_predictions(spark, sf)))
    return a.select(r("daily_mae", 6).alias("daily_mae"), r("daily_mape", 6).alias("daily_mape"))


# ---- forecast ------------------------------------------------------------------------


def q_recent_sales(spark, sf):
    return forecast.recent_sales(Inputs(spark, sf).sales, TARGET, 45)


def q_active_series(spark, sf):
    return forecast.active_series(forecast.recent_sales(Inputs(spark, sf).sales, TARGET, 45))


def q_window_unit_price(spark, sf):
    return forecast.window_unit_price(forecast.recent_sales(Inputs(spark, sf).sales, TARGET, 45))


def _features(spark, sf, days_back: int) -> DataFrame:
    i = Inputs(spark, sf)
    f = forecast.forecast_features(i.sales, i.weather, i.holidays, TARGET, days_back, mode="reference")
    return f.withColumn("std_7", r("std_7", 9))


def q_forecast_features(spark, sf):
    return _features(spark, sf, 45)


def q_forecast_features_400(spark, sf):
    return _features(spark, sf, 400)


def q_forecast_report(spark, sf):
    i = Inputs(spark, sf)
    feats = forecast.forecast_features(i.sales, i.weather, i.holidays, TARGET, 45, mode="reference")
    return forecast.forecast_report(feats, i.nomenclature, "ma_7")


def q_forecast_report_layout(spark, sf):
    i = Inputs(spark, sf)
    feats = forecast.forecast_features(i.sales, i.weather, i.holidays, TARGET, 45, mode="reference")
    report = forecast.forecast_report(feats, i.nomenclature, "ma_7")
    return forecast.report_layout(report, i.weather, i.holidays, TARGET)


# ---- ingestion: windows, landing, payloads, stream -----------------------------------------


def _bounds(sales: DataFrame, extend: int = 0) -> DataFrame:
    b = sales.agg(F.min(F.to_date("period")).alias("date_from"), F.max(F.to_date("period")).alias("date_to"))
    return b.withColumn("date_to", F.date_add("date_to", extend)) if extend else b


def q_week_windows(spark, sf):
    return landing.week_windows(_bounds(Inputs(spark, sf).sales))


def q_pending_windows(spark, sf):
    s = Inputs(spark, sf).sales
    landed = landing.week_windows(_bounds(s))
    planned = landing.week_windows(_bounds(s, EXTEND_DAYS))
    return landing.pending_windows(planned, landed)


def _land_all(spark, sales: DataFrame) -> str:
    path = shared_dir(spark, "landing")
    landing.land_windows(spark, sales, landing.week_windows(materialize(_bounds(sales), "bounds")), path)
    return path


def q_merge_chunks(spark, sf):
    path = _land_all(spark, Inputs(spark, sf).sales)
    return landing.merge_chunks(spark, path)


def q_landing_compacted(spark, sf):
    """Land all, land a month again, compact and clean up: every record once."""
    sales = Inputs(spark, sf).sales
    path = _land_all(spark, sales)
    gap = landing.week_windows(spark.createDataFrame([(GAP_FROM, GAP_TO)], "date_from string, date_to string"))
    landing.land_windows(spark, sales, gap, path)
    landing.compact(spark, path)
    landing.vacuum(spark, path)
    return landing.merge_chunks(spark, path)


def q_parse_sales_json(spark, sf):
    return payloads.parse_sales_payloads(payloads.sales_payloads(Inputs(spark, sf).sales))


def q_parse_weather_json(spark, sf):
    return payloads.parse_weather_payloads(payloads.weather_payloads(Inputs(spark, sf).weather))


def q_ingest_available_now(spark, sf):
    path = _land_all(spark, Inputs(spark, sf).sales)
    out = shared_dir(spark, "ingested")
    ingest.ingest_landed(spark, path, out, f"{out}/checkpoint")
    return landing.merge_chunks(spark, out)


def q_ingest_relanded(spark, sf):
    """Land all but the last days, ingest, land the pending windows, ingest again: every record once."""
    sales = Inputs(spark, sf).sales
    path, out = shared_dir(spark, "landing"), shared_dir(spark, "ingested")
    # One row, read by each of the window lists below.
    bounds = materialize(_bounds(sales), "bounds")
    landing.land_windows(spark, sales, landing.week_windows(bounds.withColumn("date_to", F.date_sub("date_to", EXTEND_DAYS))), path)
    ingest.ingest_landed(spark, path, out, f"{out}/checkpoint")
    pending = landing.pending_windows(landing.week_windows(bounds), landing.landed_windows(spark, path))
    landing.land_windows(spark, sales, materialize(pending, "pending"), path)
    ingest.ingest_landed(spark, path, out, f"{out}/checkpoint")
    return landing.merge_chunks(spark, out)


def q_rollup_incremental(spark, sf):
    """Land a pull without its last days and a month; refresh; land what is missing; refresh: the rollup of all records."""
    i = Inputs(spark, sf)
    path, table = shared_dir(spark, "landing"), shared_dir(spark, "rollup")
    bounds = materialize(_bounds(i.sales), "bounds")
    first = landing.week_windows(bounds.withColumn("date_to", F.date_sub("date_to", EXTEND_DAYS)))
    partial = i.sales.where((F.col("period") < F.lit(GAP_FROM)) | (F.col("period") >= F.lit(GAP_TO)))
    landing.land_windows(spark, partial, first, path)
    rollup_view.refresh_rollup(spark, path, table, f"{table}-checkpoint")
    gap = landing.week_windows(spark.createDataFrame([(GAP_FROM, GAP_TO)], "date_from string, date_to string"))
    pending = landing.pending_windows(landing.week_windows(bounds), landing.landed_windows(spark, path))
    landing.land_windows(spark, i.sales, materialize(pending.unionAll(gap), "pending"), path)
    rollup_view.refresh_rollup(spark, path, table, f"{table}-checkpoint")
    return rollup_view.read_rollup(spark, table, i.nomenclature)


# ---- models (rows-only) ------------------------------------------------------------------


def _training(i: Inputs) -> tuple[DataFrame, DataFrame, DataFrame]:
    frame = gbt.training_frame(i.daily_table, i.weather, i.holidays, i.nomenclature, fit_before=STOP_CUTOFF)
    # Boosting re-reads the frame every iteration: write it once to the shared
    # folder, so iterations (and a lost executor) read files, not the window plan.
    frame = materialize(frame, "training_frame")
    return evaluation.three_way_split(frame, STOP_CUTOFF, CUTOFF)


def _model_metrics(fs: gbt.FeatureSet) -> Query:
    def run(spark, sf):
        train, stop, test = _training(Inputs(spark, sf))
        fitted = gbt.fit(train, stop, fs)
        return gbt.evaluate(fitted, test)

    run.__name__ = f"q_model_{fs.name}"
    return run


def q_model_feature_importance(spark, sf):
    train, stop, _ = _training(Inputs(spark, sf))
    fitted = gbt.fit(train, stop, gbt.V2)
    return fitted.feature_importance(spark)


def q_model_validation_by_product(spark, sf):
    """Forecast vs fact per product on the V2 model's predictions for the reported set."""
    train, stop, test = _training(Inputs(spark, sf))
    fitted = gbt.fit(train, stop, gbt.V2)
    return evaluation.validation_by_product(gbt.validation_predictions(fitted, test))


def q_model_forecast_report(spark, sf):
    i = Inputs(spark, sf)
    train, stop, _ = _training(i)
    fitted = gbt.fit(train, stop, gbt.V2)
    feats = gbt.serving_frame(i.daily_table, i.weather, i.holidays, i.nomenclature, TARGET, 400, STOP_CUTOFF)
    return forecast.forecast_report(fitted.predict(feats, "prediction"), i.nomenclature, "prediction")


def queries() -> dict[str, Query]:
    return {
        "scan_sales": q_scan_sales,
        "sales_in_range": q_sales_in_range,
        "sales_named": q_sales_named,
        "daily_rollup": q_daily_rollup,
        "daily_rollup_no_dim": q_daily_rollup_no_dim,
        "rollup_audit": q_rollup_audit,
        "dq_missing_counts": q_dq_missing_counts,
        "calendar_features": q_calendar_features,
        "cyclic_features": q_cyclic_features,
        "weather_join_median_fill": q_weather_join_median_fill,
        "product_category": q_product_category,
        "unit_price": q_unit_price,
        "series_lags": q_series_lags,
        "series_moving_avg": q_series_moving_avg,
        "series_volatility": q_series_volatility,
        "series_ewma": q_series_ewma,
        "series_trend": q_series_trend,
        "series_features_incremental": q_series_features_incremental,
        "series_calendar_lags": q_series_calendar_lags,
        "daily_totals": q_daily_totals,
        "daily_totals_ma7": q_daily_totals_ma7,
        "top_products_by_amount": q_top_products_by_amount,
        "top_products_by_quantity": q_top_products_by_quantity,
        "weekday_totals": q_weekday_totals,
        "monthly_totals": q_monthly_totals,
        "top_product_month_matrix": q_top_product_month_matrix,
        "product_summary": q_product_summary,
        "kpis": q_kpis,
        "split_counts": q_split_counts,
        "ordered_split_counts": q_ordered_split_counts,
        "log_target": q_log_target,
        "regression_metrics": q_regression_metrics,
        "model_comparison": q_model_comparison,
        "validation_overall": q_validation_overall,
        "validation_by_product": q_validation_by_product,
        "validation_from_csv": q_validation_from_csv,
        "metrics_log": q_metrics_log,
        "validation_by_day": q_validation_by_day,
        "validation_daily_accuracy": q_validation_daily_accuracy,
        "recent_sales": q_recent_sales,
        "active_series": q_active_series,
        "window_unit_price": q_window_unit_price,
        "forecast_features": q_forecast_features,
        "forecast_features_400": q_forecast_features_400,
        "forecast_report": q_forecast_report,
        "forecast_report_layout": q_forecast_report_layout,
        "week_windows": q_week_windows,
        "pending_windows": q_pending_windows,
        "merge_chunks": q_merge_chunks,
        "landing_compacted": q_landing_compacted,
        "parse_sales_json": q_parse_sales_json,
        "parse_weather_json": q_parse_weather_json,
        "ingest_available_now": q_ingest_available_now,
        "ingest_relanded": q_ingest_relanded,
        "rollup_incremental": q_rollup_incremental,
        "model_baseline_metrics": _model_metrics(gbt.BASELINE),
        "model_v2_metrics": _model_metrics(gbt.V2),
        "model_v3_metrics": _model_metrics(gbt.V3),
        "model_feature_importance": q_model_feature_importance,
        "model_validation_by_product": q_model_validation_by_product,
        "model_forecast_report": q_model_forecast_report,
    }
