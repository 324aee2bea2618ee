"""The row at a position of a sorted frame, without sorting the frame.

Rows are counted per prefix of the first key (map-side partial counts, one small row per
prefix). The running count shows which prefix holds the position; only its rows
are looked at again, with a longer prefix, then the next key, until at most
``CELL`` rows are left. Those alone are sorted. Each round is one aggregate over the
rows left, so a billion rows under one date take a handful of rounds and no task
ever sorts more than a cell.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that are sorted by one task at most.
CELL = 100_000
#: Characters by which a prefix grows.
STEP = 2


@dataclass
class Found:
    """A row's keys; how many rows have the same keys, and how many of them come before the position."""

    keys: tuple
    equal: int
    before: int
    #: Rows sorted in the end.
    ranked: int


def key_text(df: DataFrame, key: str) -> Column:
    """The key as text that sorts alike (NULL stays NULL, which sorts first)."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.StringType):
        return F.col(key)
    if isinstance(kind, T.DateType):
        number = F.unix_date(F.col(key)).cast("long")
    elif isinstance(kind, T.IntegralType):
        number = F.col(key).cast("long")
    else:
        raise ValueError(f"no prefixes of {key}: {kind.simpleString()}")
    # The sign bit turned over: hexadecimal digits in the order of the numbers.
    return F.lpad(F.hex(number.bitwiseXOR(F.lit(-(2**63)))), 16, "0")


def row_at(df: DataFrame, keys: tuple[str, ...], position: int, cell: int | None = None) -> Found:
    """The row at ``position`` (from 0) of ``df`` sorted by ``keys``, NULLs first; ``df`` is read once per round."""
    cell = CELL if cell is None else cell
    rows, left, size = df.select(*keys), list(keys), df.count()
    if not 0 <= position < size:
        raise ValueError(f"no row {position} among {size}")
    prefix, consumed = "", False
    while size > cell and left:
        text = key_text(df, left[0])
        length = len(prefix) + STEP
        counts = rows.groupBy(F.substring(text, 1, length).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(counts, key=lambda r: (r.p is not None, (r.p or "").encode())):
            if position < r.n:
                break
            position -= r.n
        size = r.n
        rows = rows.where(text.isNull() if r.p is None else F.substring(text, 1, length) == r.p)
        # A prefix shorter than asked for is the whole key.
        consumed = r.p is None or len(r.p) < length
        prefix = "" if consumed else r.p
        if consumed:
            left.pop(0)
    if not left:
        # All rows left have the same keys.
        return Found(tuple(rows.first()), size, position, 0)
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # At most ``cell`` rows.
    for r in per_key.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).collect():
        if position < r._n:
            break
        position -= r._n
    return Found(tuple(r)[:-1], r._n, position, size)


def before_row(df: DataFrame, found: Found, keys: tuple[str, ...]) -> Column:
    """Whether a row's keys come before those of ``found``."""
    return F.struct(*keys) < F.struct(*_literals(df, found, keys))


def at_row(df: DataFrame, found: Found, keys: tuple[str, ...]) -> Column:
    """Whether a row has the keys of ``found``."""
    return F.struct(*keys) == F.struct(*_literals(df, found, keys))


def _literals(df: DataFrame, found: Found, keys: tuple[str, ...]) -> list[Column]:
    return [F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(keys, found.keys, strict=True)]
