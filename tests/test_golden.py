"""Hand-checkable series (computed with pandas 2.3.3 for the reference semantics)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ovenplan.models import gbt
from ovenplan.operators import evaluation, forecast, reports, series

Q = [3, 5, 2, 8, 13, 1, 9, 4, 7, 6]
D0 = dt.date(2024, 1, 1)

# row: lag_1, lag_7, ma_7, ma_30, std_7, ewma_7, trend, roll7
GOLDEN = [
    (0, 0, 0, 0, 0, 0, 1, None),
    (3, 0, 3, 3, 0, 3, 1, None),
    (5, 0, 4, 4, 1.414214, 4.142857, 1, None),
    (2, 0, 3.333333, 3.333333, 1.527525, 3.216216, 1, None),
    (8, 0, 4.5, 4.5, 2.645751, 4.965714, 1, None),
    (13, 0, 6.2, 6.2, 4.438468, 7.599232, 1, None),
    (1, 0, 5.333333, 5.333333, 4.501851, 5.592219, 1, 5.857143),
    (9, 3, 5.857143, 5.857143, 4.336995, 6.575403, 1, 6.0),
    (4, 5, 6, 5.625, 4.242641, 5.859924, 1.066667, 6.285714),
    (7, 2, 6.285714, 5.777778, 4.231402, 6.168081, 1.087912, 6.857143),
]


@pytest.fixture(scope="module")
def golden_daily(spark):
    rows = [(D0 + dt.timedelta(days=i), "P1", "Name 1", "W1", float(q), float(q) * 10.0) for i, q in enumerate(Q)]
    return spark.createDataFrame(
        rows, "date date, product_key string, product_name string, warehouse_key string, quantity double, amount double"
    )


def test_series_features_match_golden(golden_daily):
    out = series.with_series_features(
        golden_daily, lags=(1, 7), moving_avgs=(7, 30), std_window=7, ewma_spans=(7,), trend=(7, 30)
    ).orderBy("date")
    got = out.select("lag_1", "lag_7", "ma_7", "ma_30", "std_7", "ewma_7", "trend_7_30").collect()
    for row, exp in zip(got, GOLDEN):
        for v, e in zip(row, exp[:7]):
            assert v == pytest.approx(e, abs=1e-6)


def test_rolling_mean_including_current(golden_daily):
    out = reports.daily_totals_ma7(golden_daily).orderBy("date").collect()
    for row, exp in zip(out, GOLDEN):
        if exp[7] is None:
            assert row.quantity_ma7 is None
        else:
            assert row.quantity_ma7 == pytest.approx(exp[7], abs=1e-6)
            assert row.amount_ma7 == pytest.approx(exp[7] * 10.0, abs=1e-5)


@pytest.mark.parametrize("mode, std", [("reference", 3.522522), ("consistent", 3.804759)])
def test_serving_features(golden_daily, mode, std):
    f = forecast.tail_features(golden_daily, mode=mode).collect()[0]
    assert f.lag_7 == 8 and f.lag_14 == 0 and f.lag_30 == 0
    assert f.ma_7 == pytest.approx(6.857143, abs=1e-6)
    assert f.ma_14 == pytest.approx(5.8) and f.ma_30 == pytest.approx(5.8)
    assert f.std_7 == pytest.approx(std, abs=1e-6)
    assert f.history_rows == 10


def test_train_serve_parity(spark, golden_daily):
    """Consistent-mode serving features for day t equal the training features of a row at t."""
    nxt = golden_daily.agg(F.max("date")).collect()[0][0] + dt.timedelta(days=1)
    extra = spark.createDataFrame([(nxt, "P1", "Name 1", "W1", 1.0, 10.0)], golden_daily.schema)
    train = series.with_series_features(golden_daily.unionByName(extra), lags=(7,), moving_avgs=(7, 14, 30), std_window=7)
    row = train.where(F.col("date") == F.lit(nxt)).collect()[0]
    serve = forecast.tail_features(golden_daily, mode="consistent").collect()[0]
    for c in ("lag_7", "ma_7", "ma_14", "ma_30", "std_7"):
        assert row[c] == pytest.approx(serve[c], abs=1e-12), c


def test_regression_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 18.0), (0.0, 5.0), (40.0, 30.0)], "quantity double, predicted double")
    m = evaluation.regression_metrics(df).collect()[0]
    assert m.mae == pytest.approx(4.75)
    assert m.rmse == pytest.approx(5.766281, abs=1e-6)
    assert m.r2 == pytest.approx(0.848, abs=1e-9)
    assert m.mape == pytest.approx(18.333333, abs=1e-6)


def test_serving_frame_equals_training_row(spark, golden_daily):
    """Every input of every model for day t is what a training row at t has, with weather missing that day."""
    nxt = D0 + dt.timedelta(days=len(Q))
    extra = spark.createDataFrame([(nxt, "P1", "Name 1", "W1", 1.0, 10.0)], golden_daily.schema)
    weather = golden_daily.select("date", F.dayofmonth("date").cast("double").alias("temperature"), F.lit(0.5).alias("precipitation"))
    before = D0 + dt.timedelta(days=5)
    train = gbt.training_frame(golden_daily.unionByName(extra), weather, None, None, fit_before=before)
    row = train.where(F.col("date") == F.lit(nxt)).collect()[0]
    (serve,) = gbt.serving_frame(golden_daily, weather, None, None, nxt, fit_before=before).collect()
    assert row.temperature == 3.0  # the median of the training days alone
    for fs in gbt.FEATURE_SETS.values():
        for c in fs.features:
            assert row[c] == pytest.approx(serve[c], abs=1e-12), c


def test_trailing_mean_reads_earlier_days_only(spark):
    rows = [(D0, "A", 2.0), (D0, "A", 4.0), (D0 + dt.timedelta(1), "A", 9.0), (D0 + dt.timedelta(3), "A", 1.0), (D0, "B", 5.0)]
    df = spark.createDataFrame(rows, "date date, k string, quantity double")
    got = {(r.k, r.date.day, r.quantity): r.m for r in series.with_trailing_mean(df, "m", ["k"]).collect()}
    assert got == {("A", 1, 2.0): 0.0, ("A", 1, 4.0): 0.0, ("A", 2, 9.0): 3.0, ("A", 4, 1.0): 5.0, ("B", 1, 5.0): 0.0}
