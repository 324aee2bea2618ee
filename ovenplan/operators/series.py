"""Per-series features over the daily rollup with one window.

A series is one (product_key, warehouse_key); its rows are the days with
sales, so frames count *selling days*, not calendar days. After the rollup a
series holds at most one row per day: a window partition is bounded by the
length of the calendar however skewed the raw records are.

Lags, means, volatility, trend and price share one
``partitionBy(keys).orderBy(date)`` spec, so Catalyst evaluates them in a
single ``Window`` operator over a single sort; the EWMA adds two window
passes on the same partitioning (no further shuffle).
Every frame ends at the previous row: no feature of row *t* reads row *t*.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ovenplan.operators.rollup import SERIES_KEYS


def series_window(keys: Sequence[str] = SERIES_KEYS, order: str = "date"):
    return Window.partitionBy(*keys).orderBy(order)


def ewma_depth(span: int) -> int:
    """Rows after which an EWMA weight falls below 2**-53 of the newest one."""
    r = 1.0 - 2.0 / (span + 1.0)
    return math.ceil(53.0 * math.log(2.0) / -math.log(r))


def with_ewma(
    df: DataFrame,
    value: str,
    spans: Sequence[int],
    keys: Sequence[str] = SERIES_KEYS,
    order: str = "date",
    index: str | None = None,
) -> DataFrame:
    """pandas ``shift(1).ewm(span, adjust=True, min_periods=1).mean()`` per series.

    The mean of previous rows with weights ``r**age`` (``r = 1 - 2/(span+1)``).
    Rows are cut into blocks of B rows (B: the span's depth after which a weight
    is below 2**-53 of the newest). Inside a block, values are scaled by
    ``r**-offset`` (bounded by ``r**-B``: no overflow, unlike the running
    closed form whose ``r**-i`` is infinite after ~2,500 rows). Then for row
    *i* at offset *o* in block *k*:

        num = r**(o-1) * (prefix sum of scaled values in block k before i)
            + r**(o+B-1) * (sum of scaled values of block k-1)
        den = (1 - r**n) / (1 - r),  n = rows counted

    Three window passes (row index; prefix in block; previous block by a
    range frame), all partitioned by the series, so one shuffle; no arrays.
    Blocks before k-1 weigh less than 2**-53 and are left out. Each span has
    blocks of its own: a longer span's would overflow a shorter one's scale.
    """
    w = series_window(keys, order)
    out = df
    if index is None:
        index = "_ewma_i"
        out = out.withColumn(index, F.row_number().over(w) - 1)
    i = F.col(index)
    blocks = {s: ewma_depth(s) for s in spans}
    numbers = [F.floor(i / F.lit(b)).alias(f"_ewma_blk_{s}") for s, b in blocks.items()]
    out = out.select("*", *numbers)
    cols = []
    for s, block in blocks.items():
        blk = f"_ewma_blk_{s}"
        off = i - F.col(blk) * F.lit(block)
        in_block = Window.partitionBy(*keys, blk).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        prev_block = Window.partitionBy(*keys).orderBy(blk).rangeBetween(-1, -1)
        rows_counted = F.least(i, off + F.lit(block))
        r = 1.0 - 2.0 / (s + 1.0)
        scaled = F.col(value) * F.pow(F.lit(r), -off)
        within = F.coalesce(F.sum(scaled).over(in_block), F.lit(0.0))
        before = F.coalesce(F.sum(scaled).over(prev_block), F.lit(0.0))
        num = F.pow(F.lit(r), off - 1) * within + F.pow(F.lit(r), off + F.lit(block - 1)) * before
        den = (F.lit(1.0) - F.pow(F.lit(r), rows_counted)) / F.lit(1.0 - r)
        cols.append(F.when(i > 0, num / den).alias(f"ewma_{s}"))
    drop = {f"_ewma_blk_{s}" for s in spans} | ({"_ewma_i"} if index == "_ewma_i" else set())
    return out.select(*[c for c in out.columns if c not in drop], *cols)


def with_trailing_mean(
    df: DataFrame, name: str, keys: Sequence[str], value: str = "quantity", rows: DataFrame | None = None
) -> DataFrame:
    """Mean of ``value`` over the group's rows of earlier days, 0 before its first.

    ``rows`` (default ``df``) is what the means are taken from, for a ``df`` that
    is costly to work out again. Rows are summed per group and day first, so a window partition has at most
    one row per day, however many rows the group has.
    """
    rows = df if rows is None else rows
    per_day = rows.groupBy(*keys, "date").agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    past = series_window(keys).rowsBetween(Window.unboundedPreceding, -1)
    n = F.sum("_n").over(past)
    means = per_day.select(*keys, "date", F.when(n > 0, F.sum("_s").over(past) / n).alias("_mean"))
    joined = df.join(means, [*keys, "date"], "left")
    return joined.select(*df.columns, F.coalesce("_mean", F.lit(0.0)).alias(name))


def with_series_features(
    daily: DataFrame,
    value: str = "quantity",
    keys: Sequence[str] = SERIES_KEYS,
    lags: Sequence[int] = (7, 14, 30),
    moving_avgs: Sequence[int] = (7, 14, 30),
    std_window: int | None = 7,
    ewma_spans: Sequence[int] = (),
    trend: tuple[int, int] | None = None,
    trailing_price: bool = False,
    fill_zero: bool = True,
    trailing_mean: str | None = None,
) -> DataFrame:
    """Leak-free per-series features.

    * ``lag_k``: value k rows back.
    * ``ma_n``: mean of the previous n rows (at least one).
    * ``std_n``: sample standard deviation of the previous n rows (at least two).
    * ``ewma_s``: exponentially weighted mean of previous rows, :func:`with_ewma`.
    * ``trend_a_b``: ``ma_a / ma_b`` if ``ma_b > 0`` else 1.0, taken before the fill.
    * ``trailing_price``: ``sum(amount) / sum(quantity)`` over all previous rows
      (a price feature that does not read the target row).
    * ``trailing_mean``: a column of this name with the mean over all previous rows.
    With ``fill_zero`` NULLs (no history) become 0, as the reference does.
    """
    w = series_window(keys)
    v = F.col(value)
    feats: dict[str, Column] = {}
    for k in lags:
        feats[f"lag_{k}"] = F.lag(v, k).over(w)
    for n in moving_avgs:
        feats[f"ma_{n}"] = F.avg(v).over(w.rowsBetween(-n, -1))
    if std_window:
        feats[f"std_{std_window}"] = F.stddev_samp(v).over(w.rowsBetween(-std_window, -1))
    if trailing_price:
        past = w.rowsBetween(Window.unboundedPreceding, -1)
        q = F.sum(v).over(past)
        feats["trailing_price"] = F.when(q > 0, F.sum("amount").over(past) / q)
    if trailing_mean:
        feats[trailing_mean] = F.avg(v).over(w.rowsBetween(Window.unboundedPreceding, -1))
    if trend:
        a, b = trend
        ma_a = feats.get(f"ma_{a}", F.avg(v).over(w.rowsBetween(-a, -1)))
        ma_b = feats.get(f"ma_{b}", F.avg(v).over(w.rowsBetween(-b, -1)))
        feats[f"trend_{a}_{b}"] = F.when(ma_b > 0, ma_a / ma_b).otherwise(F.lit(1.0))
    if ewma_spans:
        feats["_row"] = F.row_number().over(w) - 1
    out = daily.select("*", *[c.alias(n) for n, c in feats.items()])
    names = [n for n in feats if n != "_row"]
    if ewma_spans:
        out = with_ewma(out, value, ewma_spans, keys, index="_row").drop("_row")
        names += [f"ewma_{s}" for s in ewma_spans]
    if fill_zero:
        # fillna semantics: NULL and NaN both become 0.
        filled = {n: F.nanvl(F.coalesce(F.col(n), F.lit(0.0)), F.lit(0.0)).alias(n) for n in names}
        out = out.select(*[filled.get(c, F.col(c)) for c in out.columns])
    return out


def with_calendar_features(
    daily: DataFrame,
    value: str = "quantity",
    keys: Sequence[str] = SERIES_KEYS,
    lags: Sequence[int] = (7, 14, 30),
    moving_avgs: Sequence[int] = (7, 14, 30),
    std_window: int | None = 7,
    fill_zero: bool = True,
) -> DataFrame:
    """Features that count calendar days instead of selling days.

    * ``lag_k``: the value exactly k days before, if the series sold that day.
    * ``ma_n``, ``std_n``: mean and sample standard deviation (at least two rows) of the
      selling days among the n days before.

    RANGE frames over the day number: all share one ``Window`` over one sort, and a
    gap in a series needs no filled-in row. ``fill_zero`` as in :func:`with_series_features`.
    """
    w = Window.partitionBy(*keys).orderBy(F.unix_date("date"))
    v = F.col(value)
    # A series has at most one row per day, so the largest value of a day is its value.
    feats = {f"lag_{k}": F.max(v).over(w.rangeBetween(-k, -k)) for k in lags}
    feats |= {f"ma_{n}": F.avg(v).over(w.rangeBetween(-n, -1)) for n in moving_avgs}
    if std_window:
        feats[f"std_{std_window}"] = F.stddev_samp(v).over(w.rangeBetween(-std_window, -1))
    if fill_zero:
        feats = {n: F.coalesce(c, F.lit(0.0)) for n, c in feats.items()}
    return daily.select("*", *[c.alias(n) for n, c in feats.items()])
