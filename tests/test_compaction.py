"""Landing compaction: the same records from fewer files, whole before and after the swap."""

import datetime as dt
import glob

import pytest

from ovenplan.sources import landing
from ovenplan.streaming import ingest, rollup_view

from .test_rollup_view import check, land, rows, sales, windows


def files(path):
    return glob.glob(f"{path}/data/run=*/week=*/*.parquet")


def stored(spark, path):
    return landing.landed_records(spark, path).count()


def landed_three_times(spark, path):
    # Weeks of January 2024 start on the 1st, 8th, 15th, 22nd.
    land(spark, path, sales(spark, range(1, 29)), 1, 28)
    land(spark, path, sales(spark, range(9, 12), 3.0), 9, 12)
    land(spark, path, sales(spark, range(12, 17), 5.0), 11, 16)


def test_same_records_fewer_files(spark, tmp_dir):
    landed_three_times(spark, tmp_dir)
    want, before = rows(landing.merge_chunks(spark, tmp_dir)), len(files(tmp_dir))
    assert stored(spark, tmp_dir) > len(want)
    assert landing.compact(spark, tmp_dir) == [dt.date(2024, 1, 8), dt.date(2024, 1, 15)]
    assert rows(landing.merge_chunks(spark, tmp_dir)) == want
    assert landing.vacuum(spark, tmp_dir) == 5
    assert rows(landing.merge_chunks(spark, tmp_dir)) == want
    # Each record once, a folder a week, untouched weeks where they were.
    assert stored(spark, tmp_dir) == len(want) and len(files(tmp_dir)) < before
    assert len(glob.glob(f"{tmp_dir}/data/run=*/week=*")) == 4
    # Nothing left to do.
    assert landing.compact(spark, tmp_dir) == [] and landing.vacuum(spark, tmp_dir) == 0


def test_failure_before_the_swap_leaves_the_old_state(spark, tmp_dir, monkeypatch):
    landed_three_times(spark, tmp_dir)
    want = rows(landing.merge_chunks(spark, tmp_dir))
    before = rows(landing.manifest(spark, tmp_dir))

    def fail(days):
        raise RuntimeError("lost between data and manifest")

    with monkeypatch.context() as m:
        m.setattr(landing, "_consecutive", fail)
        with pytest.raises(RuntimeError, match="lost"):
            landing.compact(spark, tmp_dir)
    assert rows(landing.manifest(spark, tmp_dir)) == before
    assert rows(landing.merge_chunks(spark, tmp_dir)) == want
    # The unfinished run's folders are not the vacuum's, and the old ones are all live.
    assert landing.vacuum(spark, tmp_dir) == 0
    landing.compact(spark, tmp_dir)
    landing.vacuum(spark, tmp_dir)
    assert rows(landing.merge_chunks(spark, tmp_dir)) == want and stored(spark, tmp_dir) == len(want)


def test_emptied_days_stay_empty_and_later_landings_win(spark, tmp_dir):
    land(spark, tmp_dir, sales(spark, range(1, 15)), 1, 14)
    land(spark, tmp_dir, sales(spark, []), 3, 5)
    landing.compact(spark, tmp_dir)
    landing.vacuum(spark, tmp_dir)
    days = lambda: {r.period.day for r in landing.merge_chunks(spark, tmp_dir).collect()}
    assert days() == set(range(1, 15)) - {3, 4, 5}
    land(spark, tmp_dir, sales(spark, [4], 9.0), 4, 4)
    assert days() == set(range(1, 15)) - {3, 5}
    assert {r.quantity for r in landing.merge_chunks(spark, tmp_dir).collect() if r.period.day == 4} == {36.0}


def test_windows_stay_landed(spark, tmp_dir):
    landed_three_times(spark, tmp_dir)
    landing.compact(spark, tmp_dir)
    landing.vacuum(spark, tmp_dir)
    planned = windows(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 28))
    assert landing.pending_windows(planned, landing.landed_windows(spark, tmp_dir)).count() == 0


def test_streams_that_follow_the_manifest_agree(spark, tmp_dir):
    path, copy, table = f"{tmp_dir}/landing", f"{tmp_dir}/copy", f"{tmp_dir}/rollup"
    land(spark, path, sales(spark, range(1, 29)), 1, 28)
    ingest.ingest_landed(spark, path, copy, f"{tmp_dir}/a")
    rollup_view.refresh_rollup(spark, path, table, f"{tmp_dir}/b")
    land(spark, path, sales(spark, range(9, 12), 3.0), 9, 12)
    landing.compact(spark, path)
    landing.vacuum(spark, path)
    ingest.ingest_landed(spark, path, copy, f"{tmp_dir}/a")
    rollup_view.refresh_rollup(spark, path, table, f"{tmp_dir}/b")
    assert rows(landing.merge_chunks(spark, copy)) == rows(landing.merge_chunks(spark, path))
    check(spark, path, table)


def test_superseded_partitions_are_not_read(spark, tmp_dir):
    land(spark, tmp_dir, sales(spark, range(1, 8)), 1, 7)
    land(spark, tmp_dir, sales(spark, range(1, 8), 2.0), 1, 7)
    old, new = sorted(r.run for r in landing.manifest(spark, tmp_dir).select("run").distinct().collect())
    plan = landing.merge_chunks(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    assert str(new) in plan and str(old) not in plan
    assert landing.vacuum(spark, tmp_dir) == 1


def test_consecutive_days():
    days = [dt.date(2024, 2, 28), dt.date(2024, 3, 1), dt.date(2024, 2, 29), dt.date(2024, 3, 5)]
    assert landing._consecutive(days) == [(days[0], days[1]), (days[3], days[3])]
