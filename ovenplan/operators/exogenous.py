"""Calendar, holiday and weather enrichment of a dated frame.

The holiday calendar and the daily weather have at most one row per
calendar day after :func:`one_per_day`, a bound that does not grow with the
fact volume (a century is 36,525 rows), so they are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ovenplan.functions import calendar_columns, cyclic_columns

# Serving-time weather when the forecast has no row for the day.
DEFAULT_TEMPERATURE = 10.0
DEFAULT_PRECIPITATION = 0.0


def one_per_day(daily_dim: DataFrame) -> DataFrame:
    """Keep one row per date (each value column's smallest value), so a join never multiplies facts.

    Per-column ``min`` is a hash aggregate with map-side combine; for a
    well-formed daily table (one row per date) it returns that row, and for
    duplicated dates it is deterministic.
    """
    others = [c for c in daily_dim.columns if c != "date"]
    if not others:
        return daily_dim.select("date").distinct()
    return daily_dim.groupBy("date").agg(*[F.min(c).alias(c) for c in others])


def with_calendar(df: DataFrame, holidays: DataFrame | None, iso_week: bool = True, cyclic: bool = False) -> DataFrame:
    """day_of_week (Mon=0), month, day_of_year, [week_of_year], is_weekend, is_holiday [+ sin/cos]."""
    if holidays is None:
        base, holiday = df, F.lit(0)
    else:
        flags = one_per_day(holidays.select("date")).select("date", F.lit(1).alias("_hol"))
        base, holiday = df.join(F.broadcast(flags), "date", "left"), F.coalesce(F.col("_hol"), F.lit(0))
    cal = calendar_columns("date", iso_week=iso_week)
    extra = []
    if cyclic:
        d = F.col("date")
        extra = cyclic_columns(F.weekday(d), F.month(d), F.dayofyear(d))
    return base.select(*[F.col(c) for c in df.columns], *cal, holiday.alias("is_holiday"), *extra)


def row_weighted_median(df: DataFrame, daily_values: DataFrame, value: str) -> Column:
    """Exact median of ``value`` over the rows of ``df`` joined to one-row-per-day ``daily_values``.

    Equal to ``median`` over the joined rows, computed without them: rows are
    counted per date (a partial aggregate over the date column alone), joined
    to the daily table (at most one row per calendar day) and the median is
    ``percentile(value, 0.5, frequency=rows)``. Returned as a scalar subquery.
    """
    per_day = df.groupBy("date").agg(F.count(F.lit(1)).alias("_rows"))
    weighted = per_day.join(F.broadcast(daily_values.select("date", value)), "date")
    return weighted.agg(F.percentile(F.col(value), F.lit(0.5), F.col("_rows"))).scalar()


def with_weather(df: DataFrame, weather: DataFrame, fill_median: bool = True, median_before=None) -> DataFrame:
    """Left join daily weather; NULL temperature -> median of the joined rows; NULL precipitation -> 0.

    With ``median_before``, the median is of the rows before that day only.

    The median is row-weighted: a day counts once per fact row, as in the
    joined frame (:func:`row_weighted_median`: exact, interpolated, over at
    most one row per day). It is a scalar subquery, evaluated once and
    substituted as a constant; no cross join.
    """
    w = one_per_day(weather.select("date", "temperature", "precipitation"))
    df = df.drop("temperature", "precipitation")
    joined = df.join(F.broadcast(w), "date", "left")
    if fill_median:
        rows = df if median_before is None else df.where(F.col("date") < F.lit(median_before).cast("date"))
        temperature = F.coalesce(F.col("temperature"), row_weighted_median(rows, w, "temperature"))
    else:
        temperature = F.col("temperature")
    return joined.select(
        *[F.col(c) for c in df.columns],
        temperature.alias("temperature"),
        F.coalesce(F.col("precipitation"), F.lit(0.0)).alias("precipitation"),
    )


def weather_for_day(
    weather: DataFrame,
    day,
    default_temperature: float = DEFAULT_TEMPERATURE,
    default_precipitation: float = DEFAULT_PRECIPITATION,
):
    """(temperature, precipitation) columns for one date, defaults when the day is missing."""
    w = one_per_day(weather.select("date", "temperature", "precipitation")).where(F.col("date") == F.lit(day))
    t = F.coalesce(w.select("temperature").scalar(), F.lit(default_temperature))
    p = F.coalesce(w.select("precipitation").scalar(), F.lit(default_precipitation))
    return t, p


def rows_without_temperature(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Rows of ``df`` whose date has no weather row or a NULL temperature; one row."""
    w = one_per_day(weather.select("date", "temperature"))
    joined = df.select("date").join(F.broadcast(w), "date", "left")
    return joined.agg(F.count_if(F.col("temperature").isNull()).alias("rows_without_temperature"))
