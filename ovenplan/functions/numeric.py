"""Column expressions for exact sums, guarded ratios and NumPy-style rounding.

Every helper returns a ``Column`` built only from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(c: ColumnOrName, scale: int) -> Column:
    """The value as a whole number of ``10**-scale`` units (``long``).

    ``rint`` is plain double arithmetic (``round`` on a double goes through a
    BigDecimal per row); for values carrying at most ``scale`` decimals,
    ``x * 10**scale`` is within 1e-9 of an integer, so both give the same.
    """
    return F.rint(_col(c) * F.lit(float(10**scale))).cast("long")


def money_sum(c: ColumnOrName, scale: int = 2) -> Column:
    """Order-independent sum of a money column, returned as double.

    Values are summed as whole units of ``10**-scale`` in a ``long``: the result
    does not depend on partitioning or on the order rows arrive in, so a
    re-run on another cluster layout gives the same bits. It is what Catalyst
    itself does for short decimals (sum of unscaled values).
    """
    factor = 10**scale
    return F.coalesce(F.sum(units(c, scale)), F.lit(0)) / F.lit(float(factor))


def exact_avg(c: ColumnOrName, scale: int) -> Column:
    """Mean of a column whose values carry at most ``scale`` decimals."""
    factor = 10**scale
    return F.sum(units(c, scale)) / F.lit(float(factor)) / F.count(_col(c))


def zero_sum(c: ColumnOrName) -> Column:
    """pandas ``sum``: an all-NULL group sums to 0, not NULL."""
    return F.coalesce(F.sum(_col(c)), F.lit(0.0))


def round_half_even(c: ColumnOrName, digits: int = 0) -> Column:
    """NumPy/pandas ``round``: ``rint(x * 10**d) / 10**d`` (ties to even).

    Spark's ``round`` rounds half up and ``bround`` works on the decimal
    string, so neither equals NumPy on values such as 0.575.
    """
    if digits == 0:
        return F.rint(_col(c))
    factor = float(10**digits)
    return F.rint(_col(c) * F.lit(factor)) / F.lit(factor)


def round_to_long(c: ColumnOrName) -> Column:
    """``np.round(x).astype(int)``."""
    return F.rint(_col(c)).cast("long")


def clamp_zero(c: ColumnOrName) -> Column:
    """``clip(lower=0)`` that keeps NULL as NULL (``greatest`` would not)."""
    x = _col(c)
    return F.when(x.isNull(), F.lit(None)).otherwise(F.greatest(x, F.lit(0.0)))


def guarded_ratio(num: ColumnOrName, den: ColumnOrName, default: float = 0.0) -> Column:
    """``num / den`` when ``den > 0`` else ``default`` (ANSI-safe)."""
    d = _col(den)
    return F.when(d > 0, _col(num) / d).otherwise(F.lit(default))


def floored_ratio(num: ColumnOrName, den: ColumnOrName, floor: float = 1.0) -> Column:
    """``num / max(den, floor)``."""
    return _col(num) / F.greatest(_col(den), F.lit(floor))


def pct_diff(forecast: ColumnOrName, fact: ColumnOrName, floor: float | None = None) -> Column:
    """``(forecast - fact) / fact * 100``; NULL on a zero divisor instead of an error."""
    den = _col(fact) if floor is None else F.greatest(_col(fact), F.lit(floor))
    return F.try_divide(_col(forecast) - _col(fact), den) * F.lit(100.0)
