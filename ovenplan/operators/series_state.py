"""Series features from a state per series that takes in one day at a time.

The windows of :mod:`ovenplan.operators.series` read a series' whole history for
each day's features. What they need of it is little: the newest quantities (the longest
lag or mean), one running numerator per EWMA span, and three sums. A state
row holds that; a day's features are the state before it, and taking in a day is one
join of the state with the day's rows, whatever the length of the history.

``features`` has the names and definitions of ``series.with_series_features``.

States are kept as snapshots under a folder, with a log whose rows say as of which
day each is valid. A snapshot counts once its row is in the log, so a run that
failed in between leaves the earlier ones. When earlier days have changed,
:func:`advance` goes on from the last snapshot before them; snapshots that a later row
of the log has gone back behind count no more.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ovenplan.operators.rollup import SERIES_KEYS

#: Quantities kept of each series: the longest lag and mean.
TAIL = 30
SPANS = (7, 14)
LOG = "seq long, as_of date"


def _ratio(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def _numerators(spans: Sequence[int]) -> list[str]:
    return [f"ewma_num_{s}" for s in spans]


def build(daily: DataFrame, keys: Sequence[str] = SERIES_KEYS, spans: Sequence[int] = SPANS, tail: int = TAIL) -> DataFrame:
    """The state after all days of ``daily``: one row per series.

    keys, last_date, n (rows), tail (newest quantities, newest last), quantity_sum,
    amount_sum, and ``ewma_num_s``: sum of quantities weighted by r**age.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.col("date").desc())
    ranked = daily.select("date", *keys, "quantity", "amount", F.row_number().over(newest_first).alias("_age"))
    newest = F.collect_list(F.when(F.col("_age") <= tail, F.struct("date", "quantity")))
    return ranked.groupBy(*keys).agg(
        F.max("date").alias("last_date"),
        F.count(F.lit(1)).alias("n"),
        F.sort_array(newest)["quantity"].alias("tail"),
        F.sum("quantity").alias("quantity_sum"),
        F.sum("amount").alias("amount_sum"),
        *[F.sum(F.col("quantity") * F.pow(F.lit(_ratio(s)), F.col("_age") - 1)).alias(f"ewma_num_{s}") for s in spans],
    )


def absorb(state: DataFrame, day: DataFrame, keys: Sequence[str] = SERIES_KEYS, spans: Sequence[int] = SPANS, tail: int = TAIL) -> DataFrame:
    """The state after ``day``: rollup rows of one date that is after every date in the state."""
    new = day.select(*keys, F.col("date").alias("_date"), F.col("quantity").alias("_q"), F.col("amount").alias("_amount"))
    both = state.join(new, list(keys), "full_outer")
    sold = F.col("_date").isNotNull()
    longer = F.concat(F.coalesce("tail", F.array().cast("array<double>")), F.array("_q"))
    kept = F.slice(longer, F.greatest(F.size(longer) - tail, F.lit(0)) + 1, F.lit(tail))

    def plus(column: str, value: Column | str, ratio: float = 1.0) -> Column:
        old = F.coalesce(F.col(column), F.lit(0.0))
        return F.when(sold, (old if ratio == 1.0 else old * ratio) + F.col(value)).otherwise(old).alias(column)

    return both.select(
        *keys,
        F.coalesce("_date", "last_date").alias("last_date"),
        (F.coalesce("n", F.lit(0)) + sold.cast("long")).alias("n"),
        F.when(sold, kept).otherwise(F.col("tail")).alias("tail"),
        plus("quantity_sum", "_q"),
        plus("amount_sum", "_amount"),
        *[plus(f"ewma_num_{s}", "_q", _ratio(s)) for s in spans],
    )


def _newest(n: int) -> Column:
    return F.slice("tail", F.greatest(F.size("tail") - n, F.lit(0)) + 1, F.lit(n))


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(values) > 0, total / F.size(values))


def _sample_std(values: Column) -> Column:
    squares = F.aggregate(values, F.lit(0.0), lambda a, x: a + (x - _mean(values)) * (x - _mean(values)))
    return F.when(F.size(values) > 1, F.sqrt(squares / (F.size(values) - 1)))


def feature_columns(
    lags: Sequence[int] = (1, 7, 14, 30),
    moving_avgs: Sequence[int] = (7, 14, 30),
    std_window: int = 7,
    spans: Sequence[int] = SPANS,
    trend: tuple[int, int] = (7, 30),
) -> list[Column]:
    """Columns over a state row: the features of the series' next row; 0 where it has no history (``trend``: 1)."""
    zero = F.lit(0.0)
    cols = {f"lag_{k}": F.try_element_at("tail", F.lit(-k)) for k in lags}
    cols |= {f"ma_{m}": _mean(_newest(m)) for m in moving_avgs}
    cols[f"std_{std_window}"] = _sample_std(_newest(std_window))
    for s in spans:
        # The weights 1, r, r**2, ... of n rows sum to this.
        weights = (F.lit(1.0) - F.pow(F.lit(_ratio(s)), F.col("n"))) / F.lit(1.0 - _ratio(s))
        cols[f"ewma_{s}"] = F.when(F.col("n") > 0, F.col(f"ewma_num_{s}") / weights)
    a, b = (_mean(_newest(m)) for m in trend)
    cols[f"trend_{trend[0]}_{trend[1]}"] = F.when(b > 0, a / b).otherwise(F.lit(1.0))
    cols["trailing_price"] = F.when(F.col("quantity_sum") > 0, F.col("amount_sum") / F.col("quantity_sum"))
    return [F.coalesce(c, zero).alias(name) for name, c in cols.items()]


def features(state: DataFrame, day: DataFrame, keys: Sequence[str] = SERIES_KEYS, **kw) -> DataFrame:
    """The rows of one day with their features; ``state`` is the one before the day."""
    return day.join(state, list(keys), "left").select(*[day[c] for c in day.columns], *feature_columns(**kw))


# ---- snapshots -----------------------------------------------------------------------


def snapshots(spark: SparkSession, path: str) -> list[tuple[int, dt.date]]:
    """(seq, as_of) of the snapshots that count, oldest first; at most one per calendar day."""
    try:
        log = sorted((r.seq, r.as_of) for r in spark.read.schema(LOG).parquet(f"{path}/log").collect())
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    valid: list[tuple[int, dt.date]] = []
    for seq, as_of in log:
        while valid and valid[-1][1] >= as_of:
            valid.pop()
        valid.append((seq, as_of))
    return valid


def load(spark: SparkSession, path: str, seq: int) -> DataFrame:
    return spark.read.parquet(f"{path}/state-{seq}")


def save(state: DataFrame, path: str, seq: int, as_of: dt.date) -> DataFrame:
    """Write a snapshot, then its row of the log; returns the written state."""
    spark = state.sparkSession
    state.write.mode("overwrite").parquet(f"{path}/state-{seq}")
    spark.createDataFrame([(seq, as_of)], LOG).coalesce(1).write.mode("append").parquet(f"{path}/log")
    return load(spark, path, seq)


def start(spark: SparkSession, path: str, daily: DataFrame, cutoff: dt.date) -> DataFrame:
    """The first snapshot: the state of all days before ``cutoff``, from their rows."""
    log = snapshots(spark, path)
    before = daily.where(F.col("date") < F.lit(cutoff))
    return save(build(before), path, log[-1][0] + 1 if log else 0, cutoff - dt.timedelta(days=1))


def advance(
    spark: SparkSession, path: str, daily: DataFrame, through: dt.date, changed_from: dt.date | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Take in the days after the last snapshot, up to ``through``; returns (state, features of those days' rows).

    Days are taken in one by one, each as a join of the state with that day's rows:
    only they are read of ``daily``. With ``changed_from`` the last snapshot before that
    day is gone back to. The features are None if there is no new day.
    """
    log = snapshots(spark, path)
    usable = [s for s in log if changed_from is None or s[1] < changed_from]
    if not usable:
        raise ValueError(f"no snapshot in {path}" + (f" before {changed_from}" if changed_from else ""))
    (seq, as_of), state, found = usable[-1], load(spark, path, usable[-1][0]), None
    next_seq = log[-1][0] + 1
    new = daily.where((F.col("date") > F.lit(as_of)) & (F.col("date") <= F.lit(through)))
    # At most one row per calendar day.
    days = sorted(r.date for r in new.select("date").distinct().collect())
    for day in days:
        rows = daily.where(F.col("date") == F.lit(day))
        own = features(state, rows)
        found = own if found is None else found.unionAll(own)
        state = save(absorb(state, rows), path, next_seq, day)
        next_seq += 1
    if changed_from is not None and not days and log[-1] != usable[-1]:
        # The changed days are gone: later snapshots must not count.
        state = save(state, path, next_seq, as_of)
    return state, found
