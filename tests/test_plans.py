"""Physical-plan shape: one Window for all features, no Python UDF, pushdown and pruning."""

from ovenplan.operators import rollup, series
from ovenplan.plans.registry import Inputs
from ovenplan.sources import files

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_window_for_all_series_features(spark):
    daily = Inputs(spark, SF_SMALL).daily
    out = series.with_series_features(
        daily, lags=(1, 7, 14, 30), moving_avgs=(7, 14, 30), std_window=7, ewma_spans=(), trend=(7, 30)
    )
    p = out._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Window [") == 1, p


def test_series_features_shuffle_once(spark):
    from pyspark.sql import functions as F

    daily = spark.range(5000).select(
        F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") / 10).cast("int")).alias("date"),
        (F.col("id") % 10).cast("string").alias("product_key"),
        F.lit("W").alias("warehouse_key"),
        (F.col("id") % 7 + 1).cast("double").alias("quantity"),
        F.lit(1.0).alias("amount"),
    )
    out = series.with_series_features(daily, lags=(1, 7), moving_avgs=(7,), std_window=7, ewma_spans=(7, 14), trend=(7, 30))
    p = plan(out)
    # Lags, means, std, trend and both EWMAs: one hash exchange on the series keys.
    assert p.count("Exchange hashpartitioning") == 1, p
    assert p.count("Window [") + p.count("Window(") >= 1


def test_no_python_in_library_plans(spark):
    i = Inputs(spark, SF_SMALL)
    out = series.with_series_features(i.daily, ewma_spans=(7,), trend=(7, 30))
    p = plan(out)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_range_filter_reaches_parquet_scan(spark, tmp_dir):
    from pyspark.sql import functions as F

    i = Inputs(spark, SF_SMALL)
    files.conform(i.sales, files.SALES).withColumn("note", F.lit("x")).write.parquet(f"{tmp_dir}/sales")
    df = files.sales_in_range(spark.read.parquet(f"{tmp_dir}/sales"), "1996-01-01", "1996-12-31")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        p = plan(df)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PushedFilters: [IsNotNull(period), IsNotNull(recorder_type), GreaterThanOrEqual(period" in p, p
    assert "EqualTo(recorder_type,sale)" in p, p
    # The unused column is pruned from the scan.
    assert "ReadSchema: struct<period:timestamp_ntz,product_key:string,warehouse_key:string,quantity:double,amount:double,recorder_type:string>" in p, p
    assert "note" not in p


def test_projection_prunes_scan_columns(spark):
    df = Inputs(spark, SF_SMALL).sales.select("period", "quantity")
    p = plan(df)
    assert "l_comment" not in p and "l_tax" not in p and "l_discount" not in p


def test_rollup_aggregates_before_dimension_join(spark):
    i = Inputs(spark, SF_SMALL)
    p = rollup.daily_rollup(i.sales, i.nomenclature)._jdf.queryExecution().optimizedPlan().toString()
    # The outermost join (to the product names) sits above the rollup aggregate.
    join_pos = p.find("Join LeftOuter")
    agg_pos = p.find("Aggregate [")
    assert 0 <= join_pos < agg_pos, p
