"""Calendar expressions: day of week (Mon=0), ISO week, weekend and cyclic encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Weekday names, Monday first, as shown in the production report.
WEEKDAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def day_of_week(d: ColumnOrName) -> Column:
    """Monday = 0 ... Sunday = 6 (pandas ``dayofweek``; not Spark's ``dayofweek``)."""
    return F.weekday(_col(d))


def is_weekend(d: ColumnOrName) -> Column:
    return (F.weekday(_col(d)) >= 5).cast("int")


def calendar_columns(d: ColumnOrName = "date", iso_week: bool = True) -> list[Column]:
    """day_of_week, month, day_of_year, [week_of_year], is_weekend."""
    x = _col(d)
    cols = [
        day_of_week(x).alias("day_of_week"),
        F.month(x).alias("month"),
        F.dayofyear(x).alias("day_of_year"),
    ]
    if iso_week:
        cols.append(F.weekofyear(x).alias("week_of_year"))
    cols.append(is_weekend(x).alias("is_weekend"))
    return cols


def cyclic_columns(
    dow: ColumnOrName = "day_of_week",
    month: ColumnOrName = "month",
    doy: ColumnOrName = "day_of_year",
) -> list[Column]:
    """sin/cos of 2*pi*x/period; the day-of-year period is 365 also in leap years."""
    out = []
    for name, c, period in (("dow", dow, 7), ("month", month, 12), ("doy", doy, 365)):
        angle = F.lit(2.0 * math.pi) * _col(c) / F.lit(float(period))
        out.append(F.sin(angle).alias(f"{name}_sin"))
        out.append(F.cos(angle).alias(f"{name}_cos"))
    return out


def weekday_name(d: ColumnOrName) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.element_at(names, F.weekday(_col(d)) + F.lit(1))


def month_label(d: ColumnOrName) -> Column:
    """``yyyy-MM`` (pandas ``to_period('M')`` as text)."""
    return F.date_format(_col(d), "yyyy-MM")
