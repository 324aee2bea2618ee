"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_MODELS=1 adds
the model-training queries.

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver), once, timed. Before that,
every selected query runs once untimed on the tiny sf0.001 tables
(BENCH_WARMUP_DIR) to warm the JVM.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_rollup",
    "sales_named",
    "rollup_audit",
    "dq_missing_counts",
    "calendar_features",
    "weather_join_median_fill",
    "product_category",
    "series_lags",
    "series_moving_avg",
    "series_volatility",
    "series_ewma",
    "series_trend",
    "daily_totals_ma7",
    "top_product_month_matrix",
    "product_summary",
    "kpis",
    "ordered_split_counts",
    "model_comparison",
    "validation_by_product",
    "validation_by_day",
    "forecast_features",
    "forecast_features_400",
    "forecast_report",
    "week_windows",
    "pending_windows",
    "parse_sales_json",
    "feature_frame",
]
MODELS = ["model_v2_metrics", "model_forecast_report"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else list(HEADLINE)
    if os.environ.get("BENCH_MODELS") == "1":
        names += MODELS

    from ovenplan.session import local_session

    spark = local_session(cpus, max(2 * cpus, 8), app="ovenplan-bench")
    from ovenplan.models import gbt
    from ovenplan.plans.registry import Inputs, queries

    qs = dict(queries())
    # The full V3 training frame: rollup + calendar + weather + category + every series feature.
    qs["feature_frame"] = lambda s, sf: gbt.training_frame(
        Inputs(s, sf).daily_table, Inputs(s, sf).weather, Inputs(s, sf).holidays, Inputs(s, sf).nomenclature
    )

    def run(name: str) -> float:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # Warm-up (not timed): JVM start, class loading and JIT of every operator
    # path, by running each selected query once on the tiny sf0.001 tables.
    # The measured queries never run on the measured data beforehand.
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for n in names:
            qs[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        for w in ("kpis", "weather_join_median_fill"):
            run(w)
    times = {}
    for n in names:
        times[n] = round(run(n), 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_sec_headline_queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
