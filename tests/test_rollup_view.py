"""The incremental rollup: equal to the rollup of all records, and nothing else touched."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from ovenplan.operators import rollup
from ovenplan.sources import landing
from ovenplan.streaming import rollup_view

from .test_io import SALES_DDL, windows


def sales(spark, days, quantity=1.0, keys=("A", "B")):
    rows = [(dt.datetime(2024, 1, d, 9), k, "W", quantity * d, 2.5, "sale") for d in days for k in keys]
    return spark.createDataFrame(rows, SALES_DDL)


def land(spark, path, df, f, t):
    landing.land_windows(spark, df, windows(spark, dt.date(2024, 1, f), dt.date(2024, 1, t)), path)


def files(table):
    found = glob.glob(f"{table}/date=*/*.parquet")
    return {f: os.stat(f).st_mtime_ns for f in found}


def days_of(paths):
    return {int(p.split("date=2024-01-")[1][:2]) for p in paths}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def check(spark, path, table):
    """The table's rollup and audit are those of the merged records."""
    merged = landing.merge_chunks(spark, path)
    assert rows(rollup_view.read_rollup(spark, table, None)) == rows(rollup.daily_rollup(merged, None))
    assert rows(rollup_view.read_groups(spark, table)) == rows(rollup.daily_groups(merged))


def test_only_changed_days_are_written(spark, tmp_dir):
    path, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/rollup", f"{tmp_dir}/ckpt"
    land(spark, path, sales(spark, range(1, 26)), 1, 25)
    assert rollup_view.refresh_rollup(spark, path, table, ckpt) == 1
    check(spark, path, table)
    before = files(table)
    assert days_of(before) == set(range(1, 26))
    # A window landed again with other values, and a new one.
    land(spark, path, sales(spark, range(10, 13), 3.0), 10, 12)
    land(spark, path, sales(spark, range(26, 29)), 26, 28)
    rollup_view.refresh_rollup(spark, path, table, ckpt)
    check(spark, path, table)
    after = files(table)
    unchanged = {f for f in before if after.get(f) == before[f]}
    assert days_of(unchanged) == set(range(1, 26)) - {10, 11, 12}
    assert days_of(set(after) - unchanged) == {10, 11, 12, 26, 27, 28}
    # Nothing landed: nothing done.
    rollup_view.refresh_rollup(spark, path, table, ckpt)
    assert files(table) == after


def test_only_partitions_of_changed_days_are_read(spark, tmp_dir):
    land(spark, tmp_dir, sales(spark, range(1, 26)), 1, 25)
    land(spark, tmp_dir, sales(spark, range(10, 13), 3.0), 10, 12)
    runs = [r.run for r in landing.manifest(spark, tmp_dir).select("run").distinct().orderBy("run").collect()]
    changed = windows(spark, dt.date(2024, 1, 10), dt.date(2024, 1, 15))
    latest = rollup_view.changed_days(spark, tmp_dir, changed)
    assert {r.day.day: r.run for r in latest} == dict.fromkeys((10, 11, 12), runs[1]) | dict.fromkeys((13, 14, 15), runs[0])
    df = landing.records_of_days(spark, tmp_dir, latest)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan or "PartitionFilters: [run" in plan
    assert f"{runs[1]}" in plan and "PushedFilters: [IsNotNull(period), GreaterThanOrEqual(period" in plan
    assert sorted(r.period.day for r in df.collect()) == sorted(2 * [10, 11, 12, 13, 14, 15])


def test_day_that_lost_its_records_has_no_rows(spark, tmp_dir):
    path, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/rollup", f"{tmp_dir}/ckpt"
    land(spark, path, sales(spark, range(1, 8)), 1, 7)
    rollup_view.refresh_rollup(spark, path, table, ckpt)
    land(spark, path, sales(spark, [4]), 3, 5)
    rollup_view.refresh_rollup(spark, path, table, ckpt)
    check(spark, path, table)
    assert {r.date.day for r in rollup_view.read_groups(spark, table).collect()} == {1, 2, 4, 6, 7}


def test_null_keys_and_returns_are_kept_for_the_audit(spark, tmp_dir):
    path, table, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/rollup", f"{tmp_dir}/ckpt"
    back = sales(spark, [2], -5.0, ("A",)).unionAll(sales(spark, [3], 1.0, (None, "C")))
    land(spark, path, sales(spark, [1, 2]).unionAll(back), 1, 3)
    rollup_view.refresh_rollup(spark, path, table, ckpt)
    check(spark, path, table)
    groups = rollup_view.read_groups(spark, table)
    assert groups.where(F.col("product_key").isNull()).count() == 1
    assert groups.where(F.col("quantity") < 0).count() == 1


def test_lost_checkpoint_and_repeated_batch_leave_the_same_table(spark, tmp_dir):
    path, table = f"{tmp_dir}/landing", f"{tmp_dir}/rollup"
    land(spark, path, sales(spark, range(1, 10)), 1, 9)
    land(spark, path, sales(spark, [4, 5], 2.0), 4, 5)
    rollup_view.refresh_rollup(spark, path, table, f"{tmp_dir}/a", runs_per_trigger=1)
    want = rows(rollup_view.read_groups(spark, table))
    assert rollup_view.refresh_rollup(spark, path, table, f"{tmp_dir}/b", runs_per_trigger=1) == 2
    assert rows(rollup_view.read_groups(spark, table)) == want
    check(spark, path, table)
