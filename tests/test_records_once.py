"""Metrics log without doubles, CSV with rejected lines, calendar windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ovenplan.operators import evaluation, series
from ovenplan.schemas import METRICS, PREDICTIONS
from ovenplan.sources import files, sinks


def test_a_run_is_logged_once(spark, tmp_dir):
    def log(seq, mae):
        sinks.append_metrics(spark.createDataFrame([(seq, "m", mae, 2.0, 3.0, 0.5, "f")], METRICS), tmp_dir)

    log(1, 9.0)
    log(1, 9.0)
    log(2, 7.0)
    # A failed run leaves nothing behind.
    broken = spark.createDataFrame([(3, "m", 1.0, 2.0, 3.0, 0.5, "f")], METRICS)
    broken = broken.withColumn("mae", F.when(F.raise_error(F.lit("lost")).isNull(), F.col("mae")))
    with pytest.raises(Exception, match="lost"):
        sinks.append_metrics(broken, tmp_dir)
    log(2, 7.0)
    got = sinks.read_metrics(spark, tmp_dir)
    assert got.columns == METRICS.names and [f.dataType for f in got.schema] == [f.dataType for f in METRICS]
    assert sorted((r.seq, r.mae) for r in got.collect()) == [(1, 9.0), (2, 7.0)]


def test_predictions_survive_csv(spark, tmp_dir):
    rows = [
        (dt.date(2024, 1, d), name, "W", 1.5 * d, d / 10, -0.1) for d in range(1, 9) for name in ('a "quoted", name', "plain", "ñ")
    ]
    pred = spark.createDataFrame(rows, PREDICTIONS)
    sinks.write_csv_report(pred, tmp_dir)
    lines = files.read_csv_checked(spark, tmp_dir, PREDICTIONS)
    assert files.line_counts(lines).first() == (24, 0)
    assert sorted(files.accepted(lines).collect()) == sorted(rows)
    by = [sorted(evaluation.validation_by_product(p).collect()) for p in (pred, files.accepted(lines))]
    assert by[0] == by[1]


def test_bad_lines_are_kept_and_counted(spark, tmp_dir):
    good = "2024-01-01,a,W,1.0,2.0,0.5"
    bad = ["2024-13-01,a,W,1.0,2.0,0.5", "2024-01-01,a,W,many,2.0,0.5", "2024-01-01,a,W,1.0", good + ",extra"]
    text = "\n".join([",".join(PREDICTIONS.names), good, *bad, good]) + "\n"
    spark.createDataFrame([(text,)], "t string").coalesce(1).write.option("lineSep", "\0").text(f"{tmp_dir}/raw")
    lines = files.read_csv_checked(spark, f"{tmp_dir}/raw", PREDICTIONS)
    counts = files.line_counts(lines).first()
    assert (counts.accepted, counts.rejected) == (2, 4)
    assert sorted(r._rejected for r in files.rejected(lines).collect()) == sorted(bad)
    # Reading few columns does not let a line with a bad field elsewhere through.
    assert files.accepted(lines).select("product_name").count() == 2


def test_calendar_windows_count_days(spark):
    days = [0, 1, 3, 8, 9, 31]
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=d), "P", "W", float(d + 1)) for d in days]
    df = spark.createDataFrame(rows, "date date, product_key string, warehouse_key string, quantity double")
    out = series.with_calendar_features(df, lags=(1, 7, 30), moving_avgs=(7,), std_window=7)
    got = {(r.date - dt.date(2024, 1, 1)).days: r for r in out.collect()}
    for d in days:
        before = [x + 1.0 for x in days if d - 7 <= x < d]
        assert got[d].ma_7 == (sum(before) / len(before) if before else 0.0)
        for k in (1, 7, 30):
            assert got[d][f"lag_{k}"] == (d - k + 1.0 if d - k in days else 0.0)
        mean = got[d].ma_7
        std = (sum((x - mean) ** 2 for x in before) / (len(before) - 1)) ** 0.5 if len(before) > 1 else 0.0
        assert got[d].std_7 == pytest.approx(std)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
    raw = series.with_calendar_features(df, lags=(2,), moving_avgs=(), std_window=None, fill_zero=False)
    assert {(r.date - dt.date(2024, 1, 1)).days: r.lag_2 for r in raw.collect()} == {0: None, 1: None, 3: 2.0, 8: None, 9: None, 31: None}
