import datetime as dt

import numpy as np
import pandas as pd
import pytest

from ovenplan.operators import dimension, rollup, series


@pytest.mark.parametrize("spans", [(7, 200), (2, 100)])
def test_ewma_of_mixed_spans_equals_pandas(spark, spans):
    rng = np.random.default_rng(1)
    values = rng.uniform(1, 100, 3000)
    days = [dt.date(2010, 1, 1) + dt.timedelta(days=i) for i in range(len(values))]
    pdf = pd.DataFrame({"product_key": "p", "warehouse_key": "w", "date": days, "quantity": values})
    got = series.with_ewma(spark.createDataFrame(pdf), "quantity", spans).orderBy("date").toPandas()
    for s in spans:
        want = pdf["quantity"].shift(1).ewm(span=s, adjust=True, min_periods=1).mean()
        np.testing.assert_allclose(got[f"ewma_{s}"].astype(float), want, rtol=1e-9)


def test_a_name_is_preferred_to_null(spark):
    rows = [("A", "Bread", None), ("A", None, "p"), ("B", None, None), ("p", "Folder", None)]
    dim = spark.createDataFrame(rows, "ref_key string, description string, parent_key string")
    names = {r.product_key: r.product_name for r in dimension.product_names(dim).collect()}
    assert names == {"A": "Bread", "B": None, "p": "Folder"}
    sales = spark.createDataFrame([("A",), ("B",), ("B",), ("C",), (None,)], "product_key string")
    assert rollup.records_without_name(sales, dim).first()[0] == 4
