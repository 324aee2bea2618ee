"""The row at a position, and the ordered split, without sorting or ranking a whole date."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ovenplan.operators import evaluation, selection

KEYS = ("product_key", "warehouse_key")


def first_none(v):
    return (v is not None, v if v is not None else 0) if not isinstance(v, str) else (True, v.encode())


def order(rows):
    return sorted(rows, key=lambda r: [first_none(v) for v in r])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    part = lambda: "".join(rng.choices("abé漢0", k=rng.randint(0, 5)))
    made = {(part(), part()) for _ in range(900)} | {("hot", f"w{i:04}") for i in range(700)}
    return [*made, (None, "x"), ("x", None), (None, None), ("a", "a"), ("a", "a"), ("a", "a")]


@pytest.mark.parametrize("cell", [1, 7, 100, 10_000])
def test_row_at_equals_sorting(spark, rows, cell):
    df = spark.createDataFrame(rows, "product_key string, warehouse_key string").repartition(3)
    ranked = order(rows)
    for position in (0, 1, 2, 3, 50, len(rows) // 2, len(rows) - 1, ranked.index(("hot", "w0350")), ranked.index(("a", "a")) + 1):
        found = selection.row_at(df, KEYS, position, cell)
        assert found.keys == ranked[position]
        assert found.equal == ranked.count(found.keys) and ranked.index(found.keys) + found.before == position
        assert found.ranked <= cell


def test_numbers_and_dates_have_prefixes(spark):
    numbers = [-(2**63), -5, -1, 0, 1, 7, 255, 256, 2**62, 2**63 - 1, None]
    rows = [(n, dt.date(1960, 1, 1) + dt.timedelta(days=37 * i)) for i, n in enumerate(numbers)]
    df = spark.createDataFrame(rows, "n long, d date")
    for key, i in (("n", 0), ("d", 1)):
        want = sorted((r[i] for r in rows), key=lambda v: (v is not None, v))
        assert [selection.row_at(df, (key,), p, 1).keys[0] for p in range(len(rows))] == want
    with pytest.raises(ValueError, match="no prefixes"):
        selection.row_at(df.select(F.lit(1.5).alias("x")), ("x",), 0, 1)
    with pytest.raises(ValueError, match="no row"):
        selection.row_at(df, ("n",), 11)


def split_rows(df, test_size):
    got = evaluation.ordered_split(df, test_size)
    assert got.columns == [*df.columns, "split"]
    return [(r.date, r.product_key, r.warehouse_key, r.split) for r in got.collect()]


@pytest.mark.parametrize("test_size", [0.0, 0.2, 0.5, 0.999, 1.0])
def test_one_date_holds_all_rows(spark, rows, test_size, monkeypatch):
    """Nothing beyond a cell is sorted, and the labelled rows' plan has no window, sort or shuffle at all."""
    monkeypatch.setattr(selection, "CELL", 20)
    day, seen = dt.date(2024, 1, 1), []
    inner = selection.row_at
    monkeypatch.setattr(selection, "row_at", lambda *a, **k: seen.append(inner(*a, **k)) or seen[-1])
    rows = [r for r in rows if r != ("a", "a")]
    df = spark.createDataFrame([(day, *r) for r in rows], "date date, product_key string, warehouse_key string")
    n_train = len(rows) - math.ceil(len(rows) * test_size)
    got = split_rows(df, test_size)
    assert order(r[1:3] for r in got if r[3] == "train") == order(rows)[:n_train]
    assert order(r[1:3] for r in got) == order(rows)
    assert all(f.ranked <= 20 for f in seen) and len(seen) == (0 < test_size)
    plan = evaluation.ordered_split(df, test_size)._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Window", "Sort", "Exchange"))


def test_equal_rows_on_both_sides(spark, monkeypatch):
    monkeypatch.setattr(selection, "CELL", 10)
    rows = [(dt.date(2024, 1, 1), "a", "w")] * 5 + [(dt.date(2024, 1, 2), "b", "w")] * 90 + [(dt.date(2024, 1, 3), "c", None)] * 5
    df = spark.createDataFrame(rows, "date date, product_key string, warehouse_key string").repartition(4)
    for test_size in (0.03, 0.05, 0.4, 0.95, 0.97):
        got = sorted(split_rows(df, test_size), key=lambda r: (r[0], r[3] == "test"))
        n_train = 100 - math.ceil(100 * test_size)
        assert [r[3] for r in got] == ["train"] * n_train + ["test"] * (100 - n_train)
        assert [r[0] for r in got] == [r[0] for r in rows]


def test_empty_frame(spark):
    assert split_rows(spark.createDataFrame([], "date date, product_key string, warehouse_key string"), 0.2) == []
