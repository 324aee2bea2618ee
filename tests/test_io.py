"""Landing, payloads, streaming ingest, sinks and model persistence."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ovenplan.models import gbt
from ovenplan.operators import evaluation
from ovenplan.schemas import METRICS, SALES
from ovenplan.sources import files, landing, payloads, sinks
from ovenplan.streaming import ingest

from .conftest import SF_SMALL

SALES_DDL = "period timestamp_ntz, product_key string, warehouse_key string, quantity double, amount double, recorder_type string"


def small_sales(spark, days):
    rows = [(dt.datetime(2024, 1, d, 9), "A", "W", 1.0, 2.5, "sale") for d in days]
    return spark.createDataFrame(rows, SALES_DDL)


def windows(spark, f, t):
    return landing.week_windows(spark.createDataFrame([(f, t)], "date_from date, date_to date"))


def test_landing_is_idempotent_and_extends(spark, tmp_dir):
    s = small_sales(spark, range(1, 21))
    w1 = windows(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 10))
    landing.land_windows(spark, s, w1, tmp_dir)
    landing.land_windows(spark, s, w1, tmp_dir)  # re-run: partitions replaced, not duplicated
    assert landing.merge_chunks(spark, tmp_dir).count() == 10
    planned = windows(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 20))
    pend = landing.pending_windows(planned, landing.landed_windows(spark, tmp_dir))
    assert [r.window_start.day for r in pend.orderBy("window_start").collect()] == [8, 15]
    landing.land_windows(spark, s, pend, tmp_dir)
    merged = landing.merge_chunks(spark, tmp_dir)
    assert merged.count() == 20 and merged.columns == [f.name for f in SALES.fields]
    assert landing.pending_windows(planned, landing.landed_windows(spark, tmp_dir)).count() == 0


def land(spark, path, sales, f, t):
    landing.land_windows(spark, sales, windows(spark, dt.date(2024, 1, f), dt.date(2024, 1, t)), path)


def test_overlapping_pulls_land_each_record_once(spark, tmp_dir):
    s = small_sales(spark, range(1, 21))
    land(spark, tmp_dir, s, 1, 20)
    land(spark, tmp_dir, s, 3, 20)
    assert landing.merge_chunks(spark, tmp_dir).count() == 20


def test_emptied_window_loses_its_rows(spark, tmp_dir):
    land(spark, tmp_dir, small_sales(spark, range(1, 15)), 1, 14)
    land(spark, tmp_dir, small_sales(spark, range(1, 8)), 8, 14)
    assert sorted(r.period.day for r in landing.merge_chunks(spark, tmp_dir).collect()) == list(range(1, 8))


def test_run_without_manifest_does_not_count(spark, tmp_dir):
    land(spark, tmp_dir, small_sales(spark, range(1, 8)), 1, 7)
    run = landing.manifest(spark, tmp_dir).first().run
    late = small_sales(spark, range(1, 8)).withColumn("run", F.lit(run + 1)).withColumn("week", F.trunc("period", "week"))
    late.write.mode("append").partitionBy("run", "week").parquet(f"{tmp_dir}/data")
    assert landing.merge_chunks(spark, tmp_dir).count() == 7


def test_ingest_follows_relanded_windows(spark, tmp_dir):
    path, out = f"{tmp_dir}/landing", f"{tmp_dir}/out"
    s = small_sales(spark, range(1, 21))
    land(spark, path, s, 1, 10)
    ingest.ingest_landed(spark, path, out, f"{tmp_dir}/ckpt")
    assert landing.merge_chunks(spark, out).count() == 10
    planned = windows(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 20))
    pending = landing.pending_windows(planned, landing.landed_windows(spark, path))
    landing.land_windows(spark, s, pending, path)
    ingest.ingest_landed(spark, path, out, f"{tmp_dir}/ckpt")
    ingest.ingest_landed(spark, path, out, f"{tmp_dir}/ckpt")  # nothing new
    assert landing.merge_chunks(spark, out).count() == 20
    land(spark, path, s.limit(0), 15, 20)
    ingest.ingest_landed(spark, path, out, f"{tmp_dir}/ckpt")
    assert landing.merge_chunks(spark, out).count() == 14


def test_sales_payload_roundtrip_and_empty_page(spark):
    s = small_sales(spark, range(1, 8))
    back = payloads.parse_sales_payloads(payloads.sales_payloads(s, page_size=3))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r)[:5] for r in s.collect())
    empty = spark.createDataFrame([('{"other": 1}',), ('{"value": []}',)], "payload string")
    assert payloads.parse_sales_payloads(empty).count() == 0


def test_weather_payload_keeps_nulls(spark):
    doc = '{"daily":{"time":["2024-01-01","2024-01-02"],"temperature_2m_mean":[1.5,null],"precipitation_sum":[null,0.2]}}'
    df = payloads.parse_weather_payloads(spark.createDataFrame([(doc,)], "payload string"))
    assert [tuple(r) for r in df.orderBy("date").collect()] == [
        (dt.date(2024, 1, 1), 1.5, None),
        (dt.date(2024, 1, 2), None, 0.2),
    ]


def test_available_now_ingest_resumes(spark, tmp_dir):
    land, out = f"{tmp_dir}/landing", f"{tmp_dir}/out"
    small_sales(spark, range(1, 7)).write.mode("append").parquet(land)
    ingest.ingest_available_now(spark, land, f"{out}/data", f"{out}/ckpt")
    assert ingest.read_ingested(spark, f"{out}/data").count() == 6
    ingest.ingest_available_now(spark, land, f"{out}/data", f"{out}/ckpt")  # nothing new
    assert ingest.read_ingested(spark, f"{out}/data").count() == 6
    small_sales(spark, range(10, 13)).write.mode("append").parquet(land)
    ingest.ingest_available_now(spark, land, f"{out}/data", f"{out}/ckpt")
    assert ingest.read_ingested(spark, f"{out}/data").count() == 9


def test_parquet_and_csv_sinks(spark, tmp_dir):
    s = small_sales(spark, range(1, 5))
    sinks.write_parquet(s, f"{tmp_dir}/p")
    sinks.write_parquet(s, f"{tmp_dir}/p")
    assert files.read_sales(spark, f"{tmp_dir}/p").count() == 4
    sinks.write_csv_report(s.drop("period"), f"{tmp_dir}/c", single_file=True)
    back = files.read_csv(spark, f"{tmp_dir}/c", s.drop("period").schema)
    assert back.count() == 4


def test_metrics_append_twice(spark, tmp_dir):
    row = spark.createDataFrame([(1, "m", 1.0, 2.0, 3.0, 0.5, "f")], METRICS)
    sinks.append_metrics(row, f"{tmp_dir}/m")
    sinks.append_metrics(row.withColumn("seq", F.lit(2).cast("long")), f"{tmp_dir}/m")
    log = spark.read.schema(METRICS).parquet(f"{tmp_dir}/m")
    assert log.count() == 2
    cmp = evaluation.compare_to_log(log, spark.createDataFrame([("new", 0.5)], "model string, mae double"))
    assert {r.delta_vs_first for r in cmp.collect()} == {-0.5}


@pytest.fixture(scope="module")
def planted(spark):
    """A series with a weekly pattern the model must learn."""
    d0 = dt.date(2020, 1, 6)
    rows = []
    for i in range(7 * 60):
        d = d0 + dt.timedelta(days=i)
        q = [10.0, 12.0, 14.0, 16.0, 18.0, 40.0, 50.0][d.weekday()]
        rows.append((d, "P", "W", q, q * 3.0))
    daily = spark.createDataFrame(rows, "date date, product_key string, warehouse_key string, quantity double, amount double")
    return daily.withColumn("product_name", F.lit("Bread"))


def test_model_learns_planted_pattern_and_reloads(spark, planted, tmp_dir):
    weather = planted.select("date", F.lit(5.0).alias("temperature"), F.lit(0.0).alias("precipitation"))
    frame = gbt.training_frame(planted, weather, None, None)
    train, stop, test = evaluation.three_way_split(frame, "2021-01-01", "2021-01-31")
    fitted = gbt.fit(train, stop, gbt.BASELINE, max_iter=25)
    m = gbt.evaluate(fitted, test).collect()[0]
    assert m.mae < 3.0, m
    sinks.append_metrics(gbt.metrics_row(fitted, test, 1), f"{tmp_dir}/model-metrics")
    (logged,) = spark.read.schema(METRICS).parquet(f"{tmp_dir}/model-metrics").collect()
    assert (logged.seq, logged.model, logged.mae, logged.r2) == (1, "baseline_calendar", m.mae, m.r2)
    gbt.save(fitted, f"{tmp_dir}/model")
    again = gbt.load(f"{tmp_dir}/model")
    assert again.feature_set == gbt.BASELINE and again.iterations == fitted.iterations
    a = [r.prediction for r in fitted.predict(test).orderBy("date").collect()]
    b = [r.prediction for r in again.predict(test).orderBy("date").collect()]
    assert a == b and min(a) >= 0.0


def test_patience_stops_before_the_cap(planted):
    weather = planted.select("date", F.lit(5.0).alias("temperature"), F.lit(0.0).alias("precipitation"))
    frame = gbt.training_frame(planted, weather, None, None)
    train, stop, _ = evaluation.three_way_split(frame, "2021-01-01", "2021-01-31")
    quick = dataclasses.replace(gbt.BASELINE, patience=3, depth=3, step_size=0.4)
    fitted = gbt.fit(train, stop, quick)
    assert len(fitted.stop_errors) >= fitted.iterations + 3
    assert len(fitted.stop_errors) < quick.max_iter == 500
    assert fitted.stop_errors[fitted.iterations - 1] == min(fitted.stop_errors[: fitted.iterations + 3])


def test_best_iteration_patience():
    assert gbt.best_iteration([5, 4, 3, 3.5, 3.6, 3.7, 2.0], patience=2) == 3
    assert gbt.best_iteration([5, 4, 3, 3.5, 2.0], patience=5) == 5


def test_registered_sources_read_whole_tables(spark):
    from ovenplan.plans.registry import Inputs

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert Inputs(spark, SF_SMALL).sales.count() == li


def test_partitioned_sink_replaces_only_written_partitions(spark, tmp_dir):
    s = small_sales(spark, range(1, 11)).withColumn("day", F.dayofmonth("period"))
    sinks.write_parquet(s, f"{tmp_dir}/p", partition_by=["day"])
    sinks.write_parquet(s.where("day <= 2").withColumn("quantity", F.lit(9.0)), f"{tmp_dir}/p", partition_by=["day"])
    back = spark.read.parquet(f"{tmp_dir}/p")
    assert back.count() == 10
    assert back.where("quantity = 9.0").count() == 2


def test_model_handles_more_categories_than_default_bins(spark):
    d0 = dt.date(2021, 1, 4)
    rows = [(d0 + dt.timedelta(days=i % 37), f"P{i % 300}", "W", float(i % 7 + 1), 1.0, "x") for i in range(6000)]
    daily = spark.createDataFrame(
        rows, "date date, product_key string, warehouse_key string, quantity double, amount double, product_name string"
    ).dropDuplicates(["date", "product_key", "warehouse_key"])
    weather = daily.select("date").distinct().select("date", F.lit(1.0).alias("temperature"), F.lit(0.0).alias("precipitation"))
    frame = gbt.training_frame(daily, weather, None, None)
    fitted = gbt.fit(frame, None, gbt.BASELINE, max_iter=2)
    assert fitted.predict(frame).count() == daily.count()
