"""Order-dependent steps over dates without a single-task global window.

A running position over dates is built in two levels: per-month totals
(at most 12 rows a year) get their offsets from a window over months, then
rows get their position inside their month from a window partitioned by
month. Only the month table is ever ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_before(per_date: DataFrame, value: str, out: str = "before") -> DataFrame:
    """Add ``out`` = sum of ``value`` over all earlier dates (one row per date in)."""
    month = F.trunc("date", "month")
    monthly = per_date.groupBy(month.alias("_m")).agg(F.sum(value).alias("_mv"))
    # One row per month: bounded by the calendar, small enough to broadcast.
    offsets = monthly.select(
        "_m",
        F.coalesce(
            F.sum("_mv").over(Window.orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    in_month = Window.partitionBy("_m").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return (
        per_date.withColumn("_m", month)
        .join(F.broadcast(offsets), "_m")
        .withColumn(out, F.col("_off") + F.coalesce(F.sum(value).over(in_month), F.lit(0)))
        .drop("_m", "_off")
    )


def day_index(dates: DataFrame) -> DataFrame:
    """date, idx: 0-based position of each distinct date in date order."""
    return running_before(dates.select("date").distinct().withColumn("_one", F.lit(1)), "_one", "idx").select(
        "date", F.col("idx").cast("long").alias("idx")
    )


def trailing_sums(indexed: DataFrame, n: int, columns: list[str]) -> DataFrame:
    """For a frame with one row per ``idx``: count and sums over rows idx-n+1 .. idx.

    Each row is sent to the n windows that contain it (an n-fold explode,
    pre-aggregated map-side), grouped by window end, and joined back on idx.
    """
    contrib = indexed.select(
        F.explode(F.sequence(F.col("idx"), F.col("idx") + F.lit(n - 1))).alias("_end"), *columns
    )
    sums = contrib.groupBy("_end").agg(
        F.count(F.lit(1)).alias("_cnt"), *[F.sum(c).alias(f"_sum_{c}") for c in columns]
    )
    return indexed.join(sums, indexed.idx == sums._end).drop("_end")
