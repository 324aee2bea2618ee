"""Edge cases of the reference semantics, on tiny frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ovenplan.functions import round_half_even
from ovenplan.operators import dimension, exogenous, rollup
from ovenplan.sources import landing

SALES_DDL = "period timestamp_ntz, product_key string, warehouse_key string, quantity double, amount double, recorder_type string"
NOM_DDL = "ref_key string, description string, parent_key string"


def ts(day: int, hour: int = 10) -> dt.datetime:
    return dt.datetime(2024, 3, day, hour)


def sales(spark, rows):
    return spark.createDataFrame([(*r, "sale") for r in rows], SALES_DDL)


def test_null_keys_dropped_and_returns_netted(spark):
    s = sales(
        spark,
        [
            (ts(1), None, "W", 5.0, 50.0),
            (ts(1), "A", None, 5.0, 50.0),
            (ts(2), "A", "W", 5.0, 50.0),
            (ts(2, 15), "A", "W", -5.0, -50.0),  # net zero -> dropped
            (ts(3), "A", "W", 5.0, 50.0),
            (ts(3, 15), "A", "W", -2.0, -20.0),  # net 3 -> kept
            (ts(4), "B", "W", 1.0, None),  # all-NULL amount -> 0
        ],
    )
    got = {(r.date.day, r.product_key): (r.quantity, r.amount) for r in rollup.daily_rollup(s, None).collect()}
    assert got == {(3, "A"): (3.0, 30.0), (4, "B"): (1.0, 0.0)}
    audit = rollup.rollup_audit(s).collect()[0]
    assert (audit.groups_before, audit.groups_after, audit.groups_dropped) == (3, 2, 1)


def test_duplicate_dimension_key_does_not_multiply(spark):
    s = sales(spark, [(ts(1), "A", "W", 2.0, 20.0)])
    nom = spark.createDataFrame([("A", "Bread", "G"), ("A", "Bread v2", "G"), ("G", "Bakery", None)], NOM_DDL)
    out = rollup.daily_rollup(s, nom).collect()
    assert len(out) == 1 and out[0].quantity == 2.0 and out[0].product_name == "Bread"
    assert dimension.duplicate_keys(nom).collect()[0][0] == 1


def test_no_dimension_and_categories(spark):
    s = sales(spark, [(ts(1), "A", "W", 2.0, 20.0), (ts(1), "B", "W", 1.0, 10.0), (ts(1), "C", "W", 1.0, 10.0)])
    daily = rollup.daily_rollup(s, None)
    assert {r.product_name for r in daily.collect()} == {"A", "B", "C"}
    assert {r.category for r in dimension.with_category(daily, None).collect()} == {"unknown"}
    # A: parent with a row; B: dangling parent; C: not in the dimension at all.
    nom = spark.createDataFrame([("A", "Bread", "G1"), ("B", "Bun", "G9"), ("G1", "Bakery", None)], NOM_DDL)
    named = rollup.daily_rollup(s, nom)
    got = {r.product_key: (r.product_name, r.category) for r in dimension.with_category(named, nom).collect()}
    assert got == {"A": ("Bread", "Bakery"), "B": ("Bun", "Other"), "C": ("Unknown", "Other")}


def test_weather_median_fill(spark):
    daily = spark.createDataFrame(
        [(dt.date(2024, 1, d), "A", "W", 1.0) for d in (1, 1, 1, 2, 3)],
        "date date, product_key string, warehouse_key string, quantity double",
    )
    weather = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 1.0, None), (dt.date(2024, 1, 2), 5.0, 2.0)], "date date, temperature double, precipitation double"
    )
    out = exogenous.with_weather(daily, weather).orderBy("date").collect()
    # Row-weighted median of [1, 1, 1, 5] = 1.0 fills day 3; missing precipitation -> 0.
    assert [r.temperature for r in out] == [1.0, 1.0, 1.0, 5.0, 1.0]
    assert [r.precipitation for r in out] == [0.0, 0.0, 0.0, 2.0, 0.0]


def test_weather_default_for_missing_day(spark):
    weather = spark.createDataFrame([(dt.date(2024, 1, 1), 3.0, 1.0)], "date date, temperature double, precipitation double")
    t, p = exogenous.weather_for_day(weather, "2024-01-02")
    row = weather.select(t.alias("t"), p.alias("p")).collect()[0]
    assert (row.t, row.p) == (10.0, 0.0)


@pytest.mark.parametrize(
    "day, dow, week, doy, weekend",
    [
        ("2024-12-30", 0, 1, 365, 0),
        ("2024-12-31", 1, 1, 366, 0),
        ("2026-01-01", 3, 1, 1, 0),
        ("2024-03-02", 5, 9, 62, 1),
        ("2024-03-03", 6, 9, 63, 1),
        ("2026-03-26", 3, 13, 85, 0),
    ],
)
def test_calendar(spark, day, dow, week, doy, weekend):
    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "date date")
    r = exogenous.with_calendar(df, None).collect()[0]
    assert (r.day_of_week, r.week_of_year, r.day_of_year, r.is_weekend, r.is_holiday) == (dow, week, doy, weekend, 0)


@pytest.mark.parametrize("x, d, want", [(0.25, 1, 0.2), (0.575, 2, 0.57), (2.5, 0, 2.0), (3.5, 0, 4.0), (-2.5, 0, -2.0)])
def test_round_half_even(spark, x, d, want):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(round_half_even("x", d)).collect()[0][0] == want


def test_week_windows(spark):
    b = spark.createDataFrame(
        [(dt.date(2024, 1, 1), dt.date(2024, 1, 17)), (dt.date(2024, 2, 1), dt.date(2024, 1, 1))], "date_from date, date_to date"
    )
    got = [(r.window_start.day, r.window_end.day) for r in landing.week_windows(b).orderBy("window_start").collect()]
    assert got == [(1, 7), (8, 14), (15, 17)]  # truncated last window; from > to gives none


def test_truncated_window_is_pending_again(spark):
    landed = landing.week_windows(spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 10))], "date_from date, date_to date"))
    planned = landing.week_windows(spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 20))], "date_from date, date_to date"))
    got = [r.window_start.day for r in landing.pending_windows(planned, landed).orderBy("window_start").collect()]
    assert got == [8, 15]


def test_long_series_ewma_is_finite(spark):
    from ovenplan.operators import series

    n = 3000
    df = spark.range(n).select(
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit("A").alias("product_key"),
        F.lit("W").alias("warehouse_key"),
        (F.col("id") % 13 + 1).cast("double").alias("quantity"),
    )
    out = series.with_series_features(df, lags=(), moving_avgs=(), std_window=None, ewma_spans=(7, 14))
    bad = out.where(F.isnan("ewma_7") | F.isnan("ewma_14") | F.col("ewma_7").isNull()).count()
    assert bad == 0
    last = out.orderBy(F.col("date").desc()).first()
    assert 1.0 <= last.ewma_7 <= 13.0


def test_short_series_serving_features(spark):
    from ovenplan.operators import forecast

    rows = [(dt.date(2024, 1, 1), "ONE", "W", 4.0, 8.0)]
    rows += [(dt.date(2024, 1, 1 + i), "SIX", "W", float(q), float(q)) for i, q in enumerate([1, 2, 3, 4, 5, 6])]
    recent = spark.createDataFrame(rows, "date date, product_key string, warehouse_key string, quantity double, amount double")
    got = {r.product_key: r for r in forecast.tail_features(recent, mode="reference").collect()}
    one, six = got["ONE"], got["SIX"]
    assert (one.ma_7, one.ma_30, one.lag_7, one.std_7, one.avg_price) == (4.0, 4.0, 0.0, 0.0, 2.0)
    assert six.ma_7 == 3.5 and six.lag_7 == 0.0 and six.std_7 == 0.0  # fewer than 7 rows
    assert six.avg_price == 1.0


def test_forecast_report_clamps_rounds_and_merges_names(spark):
    from ovenplan.operators import forecast

    scored = spark.createDataFrame(
        [("A", "W1", 2.5), ("A", "W2", 3.5), ("B", "W1", -4.0), ("C", "W1", 0.4)],
        "product_key string, warehouse_key string, prediction double",
    )
    nom = spark.createDataFrame([("A", "Bread", None), ("B", "Bread", None)], NOM_DDL)
    got = [tuple(r) for r in forecast.forecast_report(scored, nom).collect()]
    # A: rint(2.5)=2 + rint(3.5)=4; B clamps to 0 and merges into "Bread"; C rounds to 0 and is dropped.
    assert got == [("Bread", 6)]
