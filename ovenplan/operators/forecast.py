"""Next-day production forecast: recent window, active series, serving
features per series and the per-product report.

Serving features are one grouped aggregate per series: a ``row_number``
from the newest day (window partitioned by series, bounded by the days in
the recent window) feeds conditional aggregates, so the shuffle for the
window is reused by the grouping. No per-series loop, no driver round trip.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ovenplan.functions import calendar_columns, clamp_zero, floored_ratio, money_sum, round_to_long, weekday_name
from ovenplan.operators.dimension import UNKNOWN_NAME, with_product_name
from ovenplan.operators.exogenous import weather_for_day
from ovenplan.operators.rollup import SERIES_KEYS, daily_sales

DAYS_BACK = 45


def _date(d) -> Column:
    return F.lit(d).cast("date") if isinstance(d, (str, _dt.date)) else d


def recent_window(sales: DataFrame, target, days_back: int = DAYS_BACK) -> DataFrame:
    """Sales records of the ``days_back`` days before ``target`` (target excluded).

    The bounds are on ``period`` itself, so they reach the Parquet scan as
    pushed filters: ``[target - days_back 00:00, target 00:00)``.
    """
    t = _date(target)
    lo = F.date_sub(t, days_back).cast("timestamp_ntz")
    hi = t.cast("timestamp_ntz")
    return sales.where((F.col("period") >= lo) & (F.col("period") < hi))


def recent_sales(sales: DataFrame, target, days_back: int = DAYS_BACK) -> DataFrame:
    """date, product_key, warehouse_key, quantity, amount over the recent window (net > 0)."""
    return daily_sales(recent_window(sales, target, days_back))


def active_series(recent: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """Series with a positive total in the window."""
    return recent.groupBy(*keys).agg(F.sum("quantity").alias("_q")).where(F.col("_q") > 0).select(*keys)


def window_unit_price(recent: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """keys, avg_price = sum(amount) / max(sum(quantity), 1) over the window."""
    return recent.groupBy(*keys).agg(floored_ratio(money_sum("amount"), F.sum("quantity")).alias("avg_price"))


def tail_features(
    recent: DataFrame,
    keys: Sequence[str] = SERIES_KEYS,
    lags: Sequence[int] = (7, 14, 30),
    moving_avgs: Sequence[int] = (7, 14, 30),
    std_n: int = 7,
    mode: str = "consistent",
) -> DataFrame:
    """Per active series: lags, means and volatility as of the day after the window.

    * ``lag_k``: the k-th newest row, 0 if fewer rows.
    * ``ma_n``: mean of the newest n rows (all rows if fewer).
    * ``std_n`` with ``mode="reference"``: population std of the newest n rows,
      0 if fewer than n rows (the serving rule of the reference);
      ``mode="consistent"``: sample std of the newest n rows, at least 2 rows,
      else 0 (the training rule, so train and serve see one definition).
    Also ``avg_price`` (:func:`window_unit_price`) and ``history_rows``.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    ranked = recent.withColumn("_rn", F.row_number().over(w))
    rn, q = F.col("_rn"), F.col("quantity")
    aggs: list[Column] = [F.count(F.lit(1)).alias("history_rows"), F.sum("quantity").alias("_q")]
    for k in lags:
        aggs.append(F.coalesce(F.max(F.when(rn == k, q)), F.lit(0.0)).alias(f"lag_{k}"))
    for n in moving_avgs:
        aggs.append(F.avg(F.when(rn <= n, q)).alias(f"ma_{n}"))
    if mode == "reference":
        aggs.append(
            F.when(F.count(F.lit(1)) >= std_n, F.stddev_pop(F.when(rn <= std_n, q))).otherwise(F.lit(0.0)).alias(
                f"std_{std_n}"
            )
        )
    elif mode == "consistent":
        aggs.append(F.coalesce(F.stddev_samp(F.when(rn <= std_n, q)), F.lit(0.0)).alias(f"std_{std_n}"))
    else:
        raise ValueError(f"mode must be 'reference' or 'consistent', not {mode!r}")
    aggs.append(floored_ratio(money_sum("amount"), F.sum("quantity")).alias("avg_price"))
    out = ranked.groupBy(*keys).agg(*aggs)
    return out.where(F.col("_q") > 0).drop("_q")


def forecast_features(
    sales: DataFrame,
    weather: DataFrame,
    holidays: DataFrame | None,
    target,
    days_back: int = DAYS_BACK,
    mode: str = "consistent",
) -> DataFrame:
    """One row per active series for ``target``: V2 feature set.

    Calendar columns are constants of the target date (folded by Catalyst);
    the weather of the day and the holiday flag are scalar subqueries
    (defaults 10.0 / 0.0 when the day has no weather row).
    """
    t = _date(target)
    feats = tail_features(recent_sales(sales, target, days_back), mode=mode)
    temperature, precipitation = weather_for_day(weather, target)
    holiday = holiday_flag(holidays, target)
    return feats.select(
        "product_key",
        "warehouse_key",
        t.alias("date"),
        *calendar_columns(t),
        holiday.alias("is_holiday"),
        temperature.alias("temperature"),
        precipitation.alias("precipitation"),
        "avg_price",
        "lag_7",
        "lag_14",
        "lag_30",
        "ma_7",
        "ma_14",
        "ma_30",
        "std_7",
        "history_rows",
    )


def forecast_report(
    scored: DataFrame,
    nomenclature: DataFrame | None,
    prediction: str = "prediction",
    unknown: str = UNKNOWN_NAME,
) -> DataFrame:
    """product_name, forecast_qty: clamp at 0, round half to even, int; summed
    over warehouses per name; positive totals only, largest first."""
    per_series = scored.select("product_key", round_to_long(clamp_zero(prediction)).alias("forecast_qty"))
    named = with_product_name(per_series, nomenclature, unknown)
    report = named.groupBy("product_name").agg(F.sum("forecast_qty").alias("forecast_qty"))
    return report.where(F.col("forecast_qty") > 0).orderBy(F.col("forecast_qty").desc(), "product_name")


# Display width of the product name and the holiday labels.
NAME_WIDTH = 35
HOLIDAY_LABELS = ("yes", "no")


def holiday_flag(holidays: DataFrame | None, target) -> Column:
    """1 if ``target`` is in the holiday table (a scalar subquery), else 0."""
    if holidays is None:
        return F.lit(0)
    t = _date(target)
    return F.when(holidays.where(F.col("date") == t).select(F.count(F.lit(1))).scalar() > 0, 1).otherwise(0)


def report_layout(
    report: DataFrame, weather: DataFrame, holidays: DataFrame | None, target, name_width: int = NAME_WIDTH
) -> DataFrame:
    """The morning table for the production planner: product (name cut to
    ``name_width``), quantity, weekday name, temperature and holiday yes/no
    of the target day (one scalar each, shared by every row)."""
    t = _date(target)
    temperature, _ = weather_for_day(weather, target)
    yes, no = HOLIDAY_LABELS
    return report.select(
        F.substring("product_name", 1, name_width).alias("product"),
        "forecast_qty",
        weekday_name(t).alias("weekday"),
        temperature.alias("temperature"),
        F.when(holiday_flag(holidays, target) == 1, yes).otherwise(no).alias("holiday"),
    )
