"""Time splits, regression metrics, forecast-vs-fact validation and model comparison.

A *predictions* frame has ``date, product_name, warehouse_key, quantity,
predicted, error`` with ``predicted`` and ``error`` rounded half to even to
one digit. Validation sums of those one-digit values run as exact integer
tenths, so they are independent of evaluation order.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ovenplan.functions import clamp_zero, exact_avg, pct_diff, round_half_even, round_to_long, units
from ovenplan.operators import selection
from ovenplan.operators.ordering import running_before
from ovenplan.session import materialize

# Status bands of |diff %| (ok below the first, warn below the second).
PRODUCT_BANDS = (15.0, 30.0)
DAY_BANDS = (10.0, 20.0)


def time_split(df: DataFrame, cutoff, date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """Train: ``date < cutoff``; validation: ``date >= cutoff``."""
    c = F.lit(cutoff).cast("date") if isinstance(cutoff, (str, _dt.date)) else cutoff
    return df.where(F.col(date_col) < c), df.where(F.col(date_col) >= c)


def three_way_split(df: DataFrame, stop_cutoff, test_cutoff) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train < stop_cutoff <= early-stopping set < test_cutoff <= test (reported set)."""
    train, rest = time_split(df, stop_cutoff)
    stop, test = time_split(rest, test_cutoff)
    return train, stop, test


def split_label(df: DataFrame, cutoff) -> DataFrame:
    return df.withColumn("split", F.when(F.col("date") < F.lit(cutoff).cast("date"), "train").otherwise("validation"))


def ordered_split(df: DataFrame, test_size: float = 0.2, keys: tuple[str, ...] = ("product_key", "warehouse_key")) -> DataFrame:
    """``train_test_split(test_size, shuffle=False)`` over rows ordered by (date, keys).

    The last ``ceil(test_size * n)`` rows are ``test``. Rows are counted per
    date, the running count gives the date that straddles the boundary, and
    :func:`ovenplan.operators.selection.row_at` finds the first test row's keys in
    it from counts per key prefix. Rows are then told apart by comparing them with
    that row: no row is ranked or moved. Of rows with the same date and keys as
    that one some may be on either side; they alone are numbered and written.
    Runs when called; pass a written table, it is read several times.
    """
    per_date = df.groupBy("date").agg(F.count(F.lit(1)).alias("_n"))
    pos = running_before(per_date, "_n", "_start")
    total = per_date.agg(F.sum("_n")).first()[0] or 0
    boundary = total - math.ceil(total * test_size)
    label = lambda train: F.when(train, "train").otherwise("test").alias("split")
    # At most one row: the date that holds the first test row.
    cut = pos.where((F.col("_start") <= boundary) & (F.col("_start") + F.col("_n") > boundary)).first()
    if cut is None:
        return df.select("*", label(F.lit(boundary > 0)))
    day = F.col("date").eqNullSafe(F.lit(cut.date))
    found = selection.row_at(df.where(day), keys, boundary - cut._start)
    train = (F.col("date") < F.lit(cut.date)) | (day & selection.before_row(df, found, keys))
    if not found.before:
        return df.select("*", label(train))
    same = day & selection.at_row(df, found, keys)
    numbered = materialize(df.where(same).withColumn("_number", F.monotonically_increasing_id()), "boundary-rows")
    first = selection.row_at(numbered, ("_number",), found.before)
    ties = numbered.select(*df.columns, label(F.col("_number") < first.keys[0]))
    return df.where(~same).select("*", label(train)).unionAll(ties)


def _metric_columns(y: Column, p: Column) -> list[Column]:
    err = y - p
    return [
        F.count(F.lit(1)),
        F.avg(F.abs(err)),
        F.sqrt(F.avg(err * err)),
        F.sum(err * err),
        F.var_pop(y) * F.count(y),
        F.avg(F.when(y > 0, F.abs(err) / y)) * F.lit(100.0),
    ]


def _finish_metrics(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in df.columns if c not in ("n", "mae", "rmse", "_ss_res", "_ss_tot", "mape")],
        "n",
        "mae",
        "rmse",
        (F.lit(1.0) - F.try_divide(F.col("_ss_res"), F.col("_ss_tot"))).alias("r2"),
        "mape",
    )


_METRIC_NAMES = ["n", "mae", "rmse", "_ss_res", "_ss_tot", "mape"]


def regression_metrics(pred: DataFrame, label: str = "quantity", prediction: str = "predicted") -> DataFrame:
    """One row: n, mae, rmse, r2 (= 1 - SSres/SStot), mape (% over label > 0).

    SStot is ``var_pop(y) * n``: Spark's variance merges partial moments
    (no ``sum(y^2) - n*mean^2`` cancellation), in the same single pass.
    """
    cols = _metric_columns(F.col(label), F.col(prediction))
    return _finish_metrics(pred.agg(*[c.alias(n) for c, n in zip(cols, _METRIC_NAMES)]))


def regression_metrics_many(pred: DataFrame, predictions: dict[str, str], label: str = "quantity") -> DataFrame:
    """Metrics of several prediction columns in ONE pass; one row per model.

    ``predictions`` maps a model name to its column. All aggregates are
    computed by a single (partial + final) aggregation, then the one wide
    row is unpivoted to ``model, n, mae, rmse, r2, mape``.
    """
    y = F.col(label)
    aggs = []
    for i, col in enumerate(predictions.values()):
        for c, n in zip(_metric_columns(y, F.col(col)), _METRIC_NAMES):
            aggs.append(c.alias(f"m{i}_{n}"))
    wide = pred.agg(*aggs)
    structs = [
        F.struct(F.lit(name).alias("model"), *[F.col(f"m{i}_{n}").alias(n) for n in _METRIC_NAMES])
        for i, name in enumerate(predictions)
    ]
    long = wide.select(F.inline(F.array(*structs)))
    return _finish_metrics(long)


def predictions(scored: DataFrame, prediction: Column | str, label: str = "quantity") -> DataFrame:
    """date, product_name, warehouse_key, quantity, predicted, error (one-digit, half to even)."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    pred = round_half_even(p, 1)
    return scored.select(
        "date",
        "product_name",
        "warehouse_key",
        F.col(label).alias("quantity"),
        pred.alias("predicted"),
        round_half_even(F.col(label) - pred, 1).alias("error"),
    )


def _band(diff: Column, bands: tuple[float, float]) -> Column:
    a = F.abs(diff)
    return F.when(a < bands[0], "ok").when(a < bands[1], "warn").otherwise("bad")


def _tenths(c: str) -> Column:
    return F.sum(units(c, 1)) / F.lit(10.0)


def validation_overall(pred: DataFrame) -> DataFrame:
    """One row: period, rows, MAE of the clamped forecast, totals and diff %."""
    clamped = pred.withColumn("predicted", clamp_zero("predicted"))
    agg = clamped.agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.abs(F.col("quantity") - F.col("predicted"))).alias("mae"),
        F.sum("quantity").alias("fact_total"),
        _tenths("predicted").alias("forecast_total"),
    )
    return agg.withColumn("diff_pct", pct_diff("forecast_total", "fact_total"))


def validation_by_product(pred: DataFrame) -> DataFrame:
    """Per product name: fact, forecast (clamped, rounded), days, MAE of the
    *unclamped* error, diff % (fact floored at 1) and status band."""
    clamped = pred.withColumn("predicted", clamp_zero("predicted"))
    agg = clamped.groupBy("product_name").agg(
        F.sum("quantity").alias("fact"),
        _tenths("predicted").alias("forecast"),
        F.count_distinct("date").alias("days"),
        exact_avg(F.abs(F.col("error")), 1).alias("mae_unclamped"),
    )
    diff = round_half_even(pct_diff("forecast", "fact", floor=1.0), 1)
    return agg.select(
        "product_name",
        F.col("fact").cast("long").alias("fact"),
        round_to_long("forecast").alias("forecast"),
        "days",
        round_half_even("mae_unclamped", 1).alias("mae_unclamped"),
        diff.alias("diff_pct"),
        _band(diff, PRODUCT_BANDS).alias("status"),
    )


def validation_by_day(pred: DataFrame) -> DataFrame:
    """Per date: fact (truncated to int), forecast (rounded), diff % (unfloored fact), band."""
    clamped = pred.withColumn("predicted", clamp_zero("predicted"))
    agg = clamped.groupBy("date").agg(F.sum("quantity").alias("fact"), _tenths("predicted").alias("forecast"))
    diff = round_half_even(pct_diff("forecast", "fact"), 1)
    return agg.select(
        "date",
        F.col("fact").cast("long").alias("fact"),
        round_to_long("forecast").alias("forecast"),
        diff.alias("diff_pct"),
        _band(diff, DAY_BANDS).alias("status"),
    )


def validation_daily_accuracy(by_day: DataFrame) -> DataFrame:
    """One row: mean |fact - forecast| of the daily ints; mean |diff %|."""
    return by_day.agg(
        F.avg(F.abs(F.col("fact") - F.col("forecast"))).alias("daily_mae"),
        exact_avg(F.abs(F.col("diff_pct")), 1).alias("daily_mape"),
    )


def compare_to_log(metrics_log: DataFrame, current: DataFrame) -> DataFrame:
    """Compare the current model's metrics with every logged model and with the first one.

    ``metrics_log``: seq, model, mae, ...; ``current``: one row with ``model, mae``.
    Both are small (one row per model run). They are unioned and the first
    and current MAE are read with a window over that small frame, so the
    inputs are evaluated once (no scalar subqueries that would re-run them).
    """
    log = metrics_log.select("seq", "model", "mae", F.lit(False).alias("_cur"))
    cur = current.select(F.lit(None).cast("long").alias("seq"), "model", "mae", F.lit(True).alias("_cur"))
    everything = Window.partitionBy()
    rows = log.unionByName(cur).select(
        "*",
        F.min_by(F.when(~F.col("_cur"), F.col("mae")), F.when(~F.col("_cur"), F.col("seq"))).over(everything).alias("_first"),
        F.max(F.when(F.col("_cur"), F.col("mae"))).over(everything).alias("_cur_mae"),
        F.max(F.when(F.col("_cur"), F.col("model"))).over(everything).alias("_cur_model"),
    )
    cur_mae, first_mae = F.col("_cur_mae"), F.col("_first")
    return rows.where(~F.col("_cur")).select(
        F.col("model").alias("baseline_model"),
        F.col("mae").alias("baseline_mae"),
        F.col("_cur_model").alias("model"),
        cur_mae.alias("mae"),
        (cur_mae - F.col("mae")).alias("delta"),
        (cur_mae - first_mae).alias("delta_vs_first"),
        (F.try_divide(cur_mae - first_mae, first_mae) * F.lit(100.0)).alias("pct_vs_first"),
    )
