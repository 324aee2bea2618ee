"""Incremental landing of the sales pull: weekly windows, resume, chunk merge.

A window is ``[start, min(start + 6, to)]`` stepping from ``date_from``. Each
landing is a run: its records go to ``data/run=/week=`` (week is the ISO Monday
of the record, whatever the pull's ``date_from``), then its windows to
``manifest``. Of each day only the latest run that covered it counts, so a
window landed again, an overlapping pull and a window that has become empty
all replace what earlier runs landed, and a run that failed before its
manifest was written counts for nothing. A window is *pending* until it has
landed through its full end, so a truncated last week is fetched again when
the range grows.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ovenplan.schemas import SALES
from ovenplan.session import delete_folder
from ovenplan.sources.files import conform

MANIFEST = T.StructType().add("window_start", "date").add("window_end", "date").add("run", "long")
LANDED = T.StructType([*SALES.fields]).add("run", "long").add("week", "date")


def week_windows(bounds: DataFrame, date_from: str = "date_from", date_to: str = "date_to") -> DataFrame:
    """window_start, window_end for every row of ``bounds`` (empty when from > to).

    ``sequence`` raises when its start is after its stop, hence the guard.
    """
    f, t = F.col(date_from).cast("date"), F.col(date_to).cast("date")
    starts = F.when(f <= t, F.sequence(f, t, F.expr("INTERVAL 7 DAYS"))).otherwise(F.array().cast("array<date>"))
    return bounds.select(F.explode(starts).alias("window_start"), t.alias("_to")).select(
        "window_start", F.least(F.date_add("window_start", 6), F.col("_to")).alias("window_end")
    )


def pending_windows(planned: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned windows not landed through their full end (``left_anti``)."""
    done = landed.select("window_start", F.col("window_end").alias("_landed_end"))
    cond = (planned.window_start == done.window_start) & (done._landed_end >= planned.window_end)
    return planned.join(done, cond, "left_anti")


def landed_windows(spark: SparkSession, path: str) -> DataFrame:
    return manifest(spark, path).select("window_start", "window_end")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """window_start, window_end, run of every landing."""
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def landed_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all runs, with their run and week."""
    return spark.read.schema(LANDED).parquet(f"{path}/data")


def days_of(windows: DataFrame, *columns: str) -> DataFrame:
    """One row per window and day: week, day and ``columns``."""
    days = windows.select(F.explode(F.sequence("window_start", "window_end")).alias("day"), *columns)
    return days.withColumn("week", F.trunc("day", "week"))


def _next_run(spark: SparkSession, path: str) -> int:
    """Microseconds since 1970, and above every run of the manifest."""
    now = time.time_ns() // 1000
    try:
        last = manifest(spark, path).agg(F.max("run").alias("run")).first().run
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    return now if last is None else max(now, last + 1)


def land_windows(spark: SparkSession, sales: DataFrame, windows: DataFrame, path: str) -> DataFrame:
    """Land the records of ``windows`` as one run. Returns the windows written."""
    starts = windows.select("window_start", "window_end")
    run = F.lit(_next_run(spark, path)).alias("run")
    # At most one row per calendar day: broadcast.
    days = F.broadcast(days_of(starts).distinct())
    rows = sales.withColumn("day", F.to_date("period")).join(days, "day").drop("day").select("*", run)
    # REBALANCE clusters rows by week before the partitioned write, and AQE
    # splits large weeks / merges small ones: a few right-sized files per
    # week, instead of one file per (task, week).
    rows.hint("rebalance", "week").write.mode("append").partitionBy("run", "week").parquet(f"{path}/data")
    # One file, so that a stream of the manifest never takes half a run.
    starts.select("*", run).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return starts


def latest_runs(windows: DataFrame) -> DataFrame:
    """week, day, run: of each day that ``windows`` (rows of the manifest) cover, its latest run."""
    return days_of(windows, "run").groupBy("week", "day").agg(F.max("run").alias("run"))


def records_of_days(spark: SparkSession, path: str, latest: list[Row]) -> DataFrame:
    """The landed records of ``latest``: week, day and run of some days, at most one row per calendar day.

    The runs and weeks are literals in the query, so other partitions are not
    listed as input; the days bound ``period``, which reaches the scan.
    """
    days = spark.createDataFrame([(r.week, r.day, r.run) for r in latest], "week date, day date, run long")
    rows = landed_records(spark, path)
    if latest:
        first, last = min(r.day for r in latest), max(r.day for r in latest)
        rows = rows.where(F.col("run").isin({r.run for r in latest}) & F.col("week").isin({r.week for r in latest}))
        rows = rows.where(F.col("period") >= F.lit(first).cast("timestamp_ntz"))
        rows = rows.where(F.col("period") < F.date_add(F.lit(last), 1).cast("timestamp_ntz"))
    # At most one row per calendar day: broadcast.
    rows = rows.withColumn("day", F.to_date("period")).join(F.broadcast(days), ["run", "week", "day"])
    return conform(rows, SALES)


def merge_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The landed records, of each day those of its latest run, with the sales schema."""
    # At most one row per landed calendar day; partitions of superseded runs are not read.
    return records_of_days(spark, path, latest_runs(manifest(spark, path)).collect())


def _consecutive(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """(first, last) of each stretch of consecutive days."""
    found: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if found and found[-1][1] + dt.timedelta(days=1) == day:
            found[-1] = (found[-1][0], day)
        else:
            found.append((day, day))
    return found


def compact(spark: SparkSession, path: str) -> list[dt.date]:
    """Rewrite the weeks whose days come from several runs as one run; returns those weeks.

    Their records, of each day the latest run's, are written as a run numbered just
    after the newest one, then its windows are appended to the manifest as one file.
    That file is the swap: before it the new run counts for nothing and all is read
    as before, after it the new run is the latest of its days. A run landed meanwhile has a
    later number and is newer still. A compaction that failed is simply run again: it
    replaces what the failed one wrote. :func:`vacuum` deletes what no day reads any more.
    """
    # At most one row per landed calendar day.
    latest = latest_runs(manifest(spark, path)).collect()
    runs: dict[dt.date, set[int]] = {}
    for r in latest:
        runs.setdefault(r.week, set()).add(r.run)
    weeks = sorted(w for w, own in runs.items() if len(own) > 1)
    if not weeks:
        return []
    rewritten = [r for r in latest if len(runs[r.week]) > 1]
    run = max(r.run for r in latest) + 1
    rows = records_of_days(spark, path, rewritten).withColumn("run", F.lit(run).cast("long"))
    rows = rows.withColumn("week", F.to_date(F.trunc(F.to_date("period"), "week")))
    write = rows.hint("rebalance", "week").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write.partitionBy("run", "week").parquet(f"{path}/data")
    windows = [(first, last, run) for first, last in _consecutive([r.day for r in rewritten])]
    spark.createDataFrame(windows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return weeks


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete the (run, week) folders that no day's latest run is in; returns how many.

    Folders of runs that are not in the manifest stay, as one may be landing now.
    Nothing may still be reading the state from before the last landing or compaction.
    """
    windows = manifest(spark, path)
    listed = {r.run for r in windows.select("run").distinct().collect()}
    live = {(r.run, r.week) for r in latest_runs(windows).collect()}
    # One row per folder: no column of the files is read.
    held = {(r.run, r.week) for r in landed_records(spark, path).select("run", "week").distinct().collect()}
    dead = [(run, week) for run, week in held - live if run in listed]
    for run, week in dead:
        delete_folder(spark, f"{path}/data/run={run}/week={week}")
    return len(dead)
