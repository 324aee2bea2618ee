"""The scale-oriented rewrites equal their direct definitions (brute force / pandas)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ovenplan.operators import evaluation, reports, rollup
from ovenplan.session import materialize

DAILY_DDL = "date date, product_key string, product_name string, warehouse_key string, quantity double, amount double"


@pytest.fixture(scope="module")
def daily(spark):
    """Three series over irregular selling days (gaps, different lengths)."""
    rows = []
    d0 = dt.date(2023, 12, 20)
    for k, step, n in (("A", 1, 60), ("B", 2, 40), ("C", 3, 25)):
        for i in range(n):
            d = d0 + dt.timedelta(days=i * step + (i % 5 == 0))
            q = float((i * 7 + len(k) * 3) % 11 + 1)
            rows.append((d, k, f"Name {k}", "W", q, round(q * 2.35, 2)))
    return spark.createDataFrame(rows, DAILY_DDL)


def test_rolling_totals_equal_pandas(daily):
    got = reports.daily_totals_ma7(daily).orderBy("date").toPandas()
    pdf = daily.toPandas().groupby("date", as_index=False).agg(quantity=("quantity", "sum"), amount=("amount", "sum"))
    pdf = pdf.sort_values("date")
    want_q = pdf["quantity"].rolling(7).mean().tolist()
    want_a = pdf["amount"].rolling(7).mean().tolist()
    assert len(got) == len(pdf)
    for g, w in zip(got["quantity_ma7"].tolist(), want_q):
        assert (g is None or (isinstance(g, float) and math.isnan(g))) if math.isnan(w) else g == pytest.approx(w)
    for g, w in zip(got["amount_ma7"].tolist(), want_a):
        assert (g is None or (isinstance(g, float) and math.isnan(g))) if math.isnan(w) else g == pytest.approx(w)


@pytest.mark.parametrize("test_size", [0.2, 0.35])
def test_ordered_split_equals_positional_split(daily, test_size):
    got = {
        (r.date, r.product_key, r.warehouse_key): r.split for r in evaluation.ordered_split(daily, test_size).collect()
    }
    pdf = daily.toPandas().sort_values(["date", "product_key", "warehouse_key"]).reset_index(drop=True)
    n_test = math.ceil(test_size * len(pdf))
    for pos, r in pdf.iterrows():
        want = "train" if pos < len(pdf) - n_test else "test"
        assert got[(r.date, r.product_key, r.warehouse_key)] == want


def test_metrics_many_equals_one_at_a_time(daily):
    df = daily.withColumn("p1", F.col("quantity") * 0.9).withColumn("p2", F.col("quantity") + 1.5)
    many = {r.model: r for r in evaluation.regression_metrics_many(df, {"a": "p1", "b": "p2"}).collect()}
    for name, col in (("a", "p1"), ("b", "p2")):
        one = evaluation.regression_metrics(df, "quantity", col).collect()[0]
        for c in ("n", "mae", "rmse", "r2", "mape"):
            assert many[name][c] == pytest.approx(one[c], rel=1e-12), c


def test_grouped_pass_equals_direct_counts(spark):
    ddl = "period timestamp_ntz, product_key string, warehouse_key string, quantity double, amount double, recorder_type string"
    t = dt.datetime(2024, 1, 1, 9)
    s = spark.createDataFrame(
        [
            (t, "A", "W", 2.0, 2.0, "sale"),
            (t, None, "W", 1.0, 1.0, "sale"),
            (t, "X", None, 1.0, 1.0, "sale"),
            (t, "X", "W", -3.0, -3.0, "sale"),
            (t, "X", "W", 1.0, 1.0, "sale"),
        ],
        ddl,
    )
    nom = spark.createDataFrame([("A", "Bread", None)], "ref_key string, description string, parent_key string")
    groups = rollup.daily_groups(s)
    assert rollup.unnamed_records(groups, nom).collect()[0][0] == rollup.records_without_name(s, nom).collect()[0][0] == 4
    a = sorted(tuple(r) for r in rollup.name_rollup(rollup.keyed_groups(groups), nom).collect())
    b = sorted(tuple(r) for r in rollup.daily_rollup(s, nom).collect())
    assert a == b and len(a) == 1


def test_materialize_roundtrip(spark, daily):
    m = materialize(daily, "test-daily")
    assert m.schema == daily.schema
    assert sorted(map(tuple, m.collect())) == sorted(map(tuple, daily.collect()))
    assert spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def test_wide_matrix_equals_long_form(daily):
    wide = reports.product_month_matrix(daily, 2)
    names = [c for c in wide.columns if c != "month"]
    assert len(names) == 2
    from_wide = sorted((r.month, n, r[n]) for r in wide.collect() for n in names)
    from_long = sorted(tuple(r) for r in reports.product_month_long(daily, 2).collect())
    assert from_wide == from_long
