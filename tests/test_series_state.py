"""Series state: a day at a time gives what the windows give over the whole history."""

import datetime as dt
import random
import shutil

import pytest
from pyspark.sql import functions as F

from ovenplan.models import gbt
from ovenplan.operators import series, series_state
from ovenplan.plans.registry import STOP_CUTOFF, TARGET, Inputs

from .conftest import SF_SMALL

DAILY = "date date, product_key string, product_name string, warehouse_key string, quantity double, amount double"
NAMES = ["lag_1", "lag_7", "lag_14", "lag_30", "ma_7", "ma_14", "ma_30", "std_7", "ewma_7", "ewma_14", "trend_7_30", "trailing_price"]


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def history(n_days, seed=1):
    rng = random.Random(seed)
    rows = []
    for n in range(n_days):
        for p in "ABC":
            # C is new late; B has gaps; a lone series sells once.
            if (p == "C" and n < n_days - 4) or (p == "B" and rng.random() < 0.4):
                continue
            q = float(rng.randint(1, 50))
            rows.append((day(n), p, p, "W", q, q * rng.randint(100, 300) / 100))
    return rows + [(day(3), "D", "D", "W", 7.0, 9.0)]


def windowed(df):
    return series.with_series_features(
        df, lags=(1, 7, 14, 30), moving_avgs=(7, 14, 30), std_window=7, ewma_spans=(7, 14), trend=(7, 30), trailing_price=True
    )


def by_row(df, names=NAMES, keys=("date", "product_key", "warehouse_key")):
    return {tuple(r[k] for k in keys): [r[n] for n in names] for r in df.select(*keys, *names).collect()}


def same(a, b):
    assert a.keys() == b.keys() and a
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-9), k


@pytest.mark.parametrize("cutoff", [0, 1, 45])
def test_day_by_day_equals_windows(spark, tmp_dir, cutoff):
    rows = history(52)
    daily = spark.createDataFrame(rows, DAILY)
    first = cutoff if cutoff else 45
    if not cutoff:
        # From nothing: the first days of a short history.
        rows = [r for r in rows if r[0] < day(5)]
        daily, first = spark.createDataFrame(rows, DAILY), 0
    if cutoff == 1:
        rows = [r for r in rows if r[0] < day(7)]
        daily = spark.createDataFrame(rows, DAILY)
    series_state.start(spark, tmp_dir, daily, day(first))
    state, found = series_state.advance(spark, tmp_dir, daily, day(60))
    same(by_row(found), by_row(windowed(daily).where(F.col("date") >= F.lit(day(first)))))
    # The state is the one built from the whole history.
    names = ["last_date", "n", "tail", "quantity_sum", "amount_sum", "ewma_num_7", "ewma_num_14"]
    got, want = (by_row(s, names, ("product_key", "warehouse_key")) for s in (state, series_state.build(daily)))
    assert got.keys() == want.keys()
    for k in got:
        assert got[k][:3] == want[k][:3] and got[k][3:] == pytest.approx(want[k][3:], rel=1e-12)
        assert len(got[k][2]) <= series_state.TAIL


def test_only_new_days_are_read(spark, tmp_dir):
    rows, table, path = history(30), f"{tmp_dir}/daily", f"{tmp_dir}/state"
    spark.createDataFrame(rows, DAILY).write.partitionBy("date").parquet(table)
    read = lambda: spark.read.parquet(table).select(*[c.split()[0] for c in DAILY.split(", ")])
    want = by_row(windowed(read()).where(F.col("date") >= F.lit(day(25))))
    series_state.start(spark, path, read(), day(25))
    for n in range(25):
        shutil.rmtree(f"{table}/date={day(n)}")
    _, found = series_state.advance(spark, path, read(), day(30))
    same(by_row(found), want)
    # Once more: nothing new.
    assert series_state.advance(spark, path, read(), day(30))[1] is None


def test_changed_days_are_taken_in_again(spark, tmp_dir):
    old, rows = spark.createDataFrame(history(30), DAILY), history(30)
    rows = [r if r[0] != day(27) else (*r[:4], r[4] + 100.0, r[5]) for r in rows if r[0] != day(28)]
    new = spark.createDataFrame(rows, DAILY)
    series_state.start(spark, tmp_dir, old, day(25))
    series_state.advance(spark, tmp_dir, old, day(40))
    state, found = series_state.advance(spark, tmp_dir, new, day(40), changed_from=day(27))
    same(by_row(found), by_row(windowed(new).where(F.col("date") >= F.lit(day(27)))))
    assert [as_of for _, as_of in series_state.snapshots(spark, tmp_dir)] == [day(n) for n in (24, 25, 26, 27, 29)]
    # The last days are gone altogether: their snapshots count no more.
    kept = new.where(F.col("date") < F.lit(day(26)))
    series_state.advance(spark, tmp_dir, kept, day(40), changed_from=day(26))
    assert series_state.snapshots(spark, tmp_dir)[-1][1] == day(25)
    with pytest.raises(ValueError, match="no snapshot"):
        series_state.advance(spark, tmp_dir, new, day(40), changed_from=day(20))


def test_snapshot_without_its_log_row_does_not_count(spark, tmp_dir):
    daily = spark.createDataFrame(history(30), DAILY)
    series_state.start(spark, tmp_dir, daily, day(25))
    # A run that died while writing its state: the folder is there, its row is not.
    spark.range(3).write.parquet(f"{tmp_dir}/state-1")
    _, found = series_state.advance(spark, tmp_dir, daily, day(30))
    same(by_row(found), by_row(windowed(daily).where(F.col("date") >= F.lit(day(25)))))


def test_serving_frame_from_state(spark):
    i = Inputs(spark, SF_SMALL)
    want = gbt.serving_frame(i.daily_table, i.weather, i.holidays, i.nomenclature, TARGET, 400, STOP_CUTOFF)
    state = series_state.build(i.daily_table.where(F.col("date") < F.lit(TARGET).cast("date")))
    fill = gbt.temperature_fill(i.daily_table, i.weather, STOP_CUTOFF)
    got = gbt.serving_frame_from_state(state, i.weather, i.holidays, i.nomenclature, TARGET, fill, 400)
    names = sorted({f for fs in gbt.FEATURE_SETS.values() for f in fs.features})
    assert set(names) <= set(got.columns)
    same(by_row(got, names), by_row(want, names))


def test_empty_history(spark, tmp_dir):
    daily = spark.createDataFrame([], DAILY)
    series_state.start(spark, tmp_dir, daily, day(0))
    state, found = series_state.advance(spark, tmp_dir, daily, day(9))
    assert state.count() == 0 and found is None
