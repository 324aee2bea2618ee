"""DuckDB SQL for every registered query, over the raw test tables.

Each statement carries its own CTEs (``sales``, ``nomenclature``,
``weather_daily``, ``holidays``, ``dim``, ``daily``) so it runs alone
against the pre-registered views. The SQL is written the direct way
(join, then group; window functions; self-joins) so that it checks the
DataFrame plans rather than repeating them.
"""

from __future__ import annotations

SALES = """
sales AS (
  SELECT l_shipdate AS period, p_brand AS product_key, CAST(n_regionkey AS VARCHAR) AS warehouse_key,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DOUBLE) AS quantity,
         CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DOUBLE) AS amount,
         CASE WHEN l_linestatus = 'F' THEN 'sale' ELSE 'other' END AS recorder_type
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey)"""

NOMENCLATURE = """
brands AS (SELECT DISTINCT p_brand AS ref_key, CAST(substr(p_brand, 7) AS INTEGER) AS k FROM part),
nomenclature AS (
  SELECT ref_key, CASE WHEN k = 2 THEN 'Product 1' ELSE 'Product ' || k END AS description,
         'G' || (k % 5) AS parent_key FROM brands WHERE k % 11 <> 0
  UNION ALL
  SELECT DISTINCT 'G' || (k % 5), 'Group ' || (k % 5), NULL FROM brands WHERE k % 5 <> 4),
dim AS (
  SELECT ref_key, arg_min(description, (description, parent_key)) AS description,
         arg_min(parent_key, (description, parent_key)) AS parent_key
  FROM nomenclature GROUP BY ref_key)"""

WEATHER = """
shipdays AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem),
weather_daily AS (
  SELECT date, CAST((dayofyear(date) % 50) / 2.0 - 10 AS DOUBLE) AS temperature,
         CAST(CASE WHEN day(date) % 3 = 0 THEN NULL ELSE (day(date) % 7) / 2.0 END AS DOUBLE) AS precipitation
  FROM shipdays WHERE day(date) % 17 <> 0),
holidays AS (
  SELECT date FROM shipdays WHERE strftime(date, '%m-%d') IN
    ('01-01','01-02','01-07','03-08','03-21','03-22','03-23','05-01','05-07','05-09','07-06','08-30','10-25','12-16'))"""

# The reference order: join the dimension to the records, then group by name too.
DAILY = """
named AS (
  SELECT CAST(s.period AS DATE) AS date, s.product_key, COALESCE(d.description, 'Unknown') AS product_name,
         s.warehouse_key, s.quantity, s.amount
  FROM sales s LEFT JOIN dim d ON s.product_key = d.ref_key
  WHERE s.product_key IS NOT NULL AND s.warehouse_key IS NOT NULL),
groups AS (
  SELECT date, product_key, product_name, warehouse_key, COALESCE(SUM(quantity), 0) AS quantity,
         CAST(COALESCE(SUM(CAST(amount AS DECIMAL(18, 2))), 0) AS DOUBLE) AS amount
  FROM named GROUP BY date, product_key, product_name, warehouse_key),
daily AS (SELECT * FROM groups WHERE quantity > 0)"""


def with_ctes(*parts: str, body: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n" + body.strip()


BASE = (SALES, NOMENCLATURE, DAILY)
ALL = (SALES, NOMENCLATURE, WEATHER, DAILY)


MONEY = "CAST(COALESCE(SUM(CAST({x} AS DECIMAL(18, 2))), 0) AS DOUBLE)"
SERIES_W = "PARTITION BY product_key, warehouse_key ORDER BY date"
CUTOFF = "DATE '2001-01-01'"
TARGET = "DATE '2001-11-05'"
STATE_CUTOFF = "DATE '2001-10-26'"


def money(x: str = "amount") -> str:
    return MONEY.format(x=x)


def trailing(fn: str, n: int) -> str:
    return f"{fn} OVER ({SERIES_W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def recent_cte(days_back: int) -> str:
    return f"""
recent AS (
  SELECT CAST(period AS DATE) AS date, product_key, warehouse_key, COALESCE(SUM(quantity), 0) AS quantity,
         {money()} AS amount
  FROM sales
  WHERE period >= {TARGET} - INTERVAL {days_back} DAY AND period < {TARGET}
    AND product_key IS NOT NULL AND warehouse_key IS NOT NULL
  GROUP BY 1, 2, 3 HAVING COALESCE(SUM(quantity), 0) > 0)"""


def serving_cte(days_back: int) -> str:
    return recent_cte(days_back) + f""",
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY product_key, warehouse_key ORDER BY date DESC) AS rn FROM recent),
serving AS (
  SELECT product_key, warehouse_key, COUNT(*) AS history_rows,
         COALESCE(MAX(CASE WHEN rn = 7 THEN quantity END), 0) AS lag_7,
         COALESCE(MAX(CASE WHEN rn = 14 THEN quantity END), 0) AS lag_14,
         COALESCE(MAX(CASE WHEN rn = 30 THEN quantity END), 0) AS lag_30,
         AVG(CASE WHEN rn <= 7 THEN quantity END) AS ma_7,
         AVG(CASE WHEN rn <= 14 THEN quantity END) AS ma_14,
         AVG(CASE WHEN rn <= 30 THEN quantity END) AS ma_30,
         CASE WHEN COUNT(*) >= 7 THEN STDDEV_POP(CASE WHEN rn <= 7 THEN quantity END) ELSE 0 END AS std_7,
         {money()} / GREATEST(SUM(quantity), 1) AS avg_price
  FROM ranked GROUP BY product_key, warehouse_key HAVING SUM(quantity) > 0)"""


def features_body() -> str:
    return f"""
SELECT product_key, warehouse_key, {TARGET} AS date, CAST(isodow({TARGET}) - 1 AS INTEGER) AS day_of_week,
       CAST(month({TARGET}) AS INTEGER) AS month, CAST(dayofyear({TARGET}) AS INTEGER) AS day_of_year,
       CAST(weekofyear({TARGET}) AS INTEGER) AS week_of_year,
       CASE WHEN isodow({TARGET}) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN EXISTS (SELECT 1 FROM holidays WHERE date = {TARGET}) THEN 1 ELSE 0 END AS is_holiday,
       COALESCE((SELECT temperature FROM weather_daily WHERE date = {TARGET}), 10.0) AS temperature,
       COALESCE((SELECT precipitation FROM weather_daily WHERE date = {TARGET}), 0.0) AS precipitation,
       avg_price, lag_7, lag_14, lag_30, ma_7, ma_14, ma_30, round_even(std_7, 9) AS std_7, history_rows
FROM serving"""


def ewma_cte(spans: tuple[int, ...]) -> str:
    """EWMA of previous rows by explicit weights over a self-join on row number."""
    import math

    depth = {s: math.ceil(53.0 * math.log(2.0) / -math.log(1.0 - 2.0 / (s + 1.0))) for s in spans}
    kmax = max(depth.values())
    cols = []
    for s in spans:
        rr = f"(1.0::DOUBLE - 2.0::DOUBLE / {s + 1}.0::DOUBLE)"
        wgt = f"POWER({rr}, a.rn - 1 - b.rn)"
        flt = f"FILTER (WHERE b.rn >= a.rn - {depth[s]})"
        cols.append(f"SUM({wgt} * b.quantity) {flt} / SUM({wgt}) {flt} AS ewma_{s}")
    return f"""
numbered AS (SELECT *, ROW_NUMBER() OVER ({SERIES_W}) AS rn FROM daily),
ewma_pairs AS (
  SELECT a.product_key, a.warehouse_key, a.date, {", ".join(cols)}
  FROM numbered a JOIN numbered b
    ON a.product_key = b.product_key AND a.warehouse_key = b.warehouse_key AND b.rn < a.rn AND b.rn >= a.rn - {kmax}
  GROUP BY a.product_key, a.warehouse_key, a.date),
ewma AS (
  SELECT d.*, {", ".join(f"COALESCE(e.ewma_{s}, 0) AS ewma_{s}" for s in spans)}
  FROM daily d LEFT JOIN ewma_pairs e USING (product_key, warehouse_key, date))"""


def windows_cte(name: str, extend: int) -> str:
    return f"""
{name}_b AS (SELECT MIN(CAST(period AS DATE)) AS f, MAX(CAST(period AS DATE)) + {extend} AS t FROM sales),
{name} AS (
  SELECT CAST(s AS DATE) AS window_start, LEAST(CAST(s AS DATE) + 6, t) AS window_end
  FROM (SELECT unnest(generate_series(f, t, INTERVAL 7 DAY)) AS s, t FROM {name}_b WHERE f <= t))"""


NAIVE = f"""
naive AS (
  SELECT date, product_key, product_name, warehouse_key, quantity,
         COALESCE(LAG(quantity, 7) OVER ({SERIES_W}), 0) AS lag_7,
         COALESCE({trailing("AVG(quantity)", 7)}, 0) AS ma_7,
         COALESCE({trailing("AVG(quantity)", 30)}, 0) AS ma_30
  FROM daily),
val AS (SELECT n.*, e.ewma_7 FROM naive n JOIN ewma e USING (product_key, warehouse_key, date)
        WHERE n.date >= {CUTOFF}),
val_mean AS (SELECT AVG(quantity) AS m FROM val)"""


def metrics_select(seq: int, model: str, col: str) -> str:
    err = f"(quantity - {col})"
    return f"""
SELECT CAST({seq} AS BIGINT) AS seq, '{model}' AS model,
       round_even(AVG(ABS({err})), 6) AS mae, round_even(SQRT(AVG({err} * {err})), 6) AS rmse,
       round_even(1 - SUM({err} * {err}) / SUM((quantity - (SELECT m FROM val_mean)) * (quantity - (SELECT m FROM val_mean))), 6) AS r2,
       round_even(AVG(CASE WHEN quantity > 0 THEN ABS({err}) / quantity END) * 100, 6) AS mape,
       COUNT(*) AS n
FROM val"""


PRED = f"""
pred AS (
  SELECT date, product_name, warehouse_key, quantity, round_even(ma_7, 1) AS predicted,
         round_even(quantity - round_even(ma_7, 1), 1) AS error
  FROM naive WHERE date >= {CUTOFF}),
clamped AS (SELECT date, product_name, warehouse_key, quantity, GREATEST(predicted, 0) AS predicted, error FROM pred)"""

BY_DAY = f"""
by_day_raw AS (
  SELECT date, SUM(quantity) AS fact_raw,
         CAST(SUM(CAST(predicted AS DECIMAL(18, 1))) AS DOUBLE) AS forecast_raw
  FROM clamped GROUP BY date),
by_day AS (
  SELECT date, CAST(trunc(fact_raw) AS BIGINT) AS fact, CAST(round_even(forecast_raw, 0) AS BIGINT) AS forecast,
         round_even((forecast_raw - fact_raw) / fact_raw * 100, 1) AS diff_pct
  FROM by_day_raw)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    W = WEATHER

    # ---- sources, rollup, data quality
    q["scan_sales"] = with_ctes(SALES, body="SELECT * FROM sales")
    q["sales_in_range"] = with_ctes(
        SALES,
        body="""
SELECT period, product_key, warehouse_key, quantity, amount FROM sales
WHERE period >= TIMESTAMP '1996-01-01 00:00:00' AND period <= TIMESTAMP '1998-12-31 23:59:59'
  AND recorder_type = 'sale'""",
    )
    q["sales_named"] = with_ctes(
        SALES,
        NOMENCLATURE,
        body="""
SELECT s.period, s.product_key, COALESCE(d.description, 'Unknown') AS product_name, s.warehouse_key,
       s.quantity, s.amount
FROM sales s LEFT JOIN dim d ON s.product_key = d.ref_key""",
    )
    q["daily_rollup"] = with_ctes(*BASE, body="SELECT * FROM daily")
    q["rollup_incremental"] = q["daily_rollup"]
    q["daily_rollup_no_dim"] = with_ctes(
        SALES,
        body=f"""
SELECT CAST(period AS DATE) AS date, product_key, product_key AS product_name, warehouse_key,
       COALESCE(SUM(quantity), 0) AS quantity, {money()} AS amount
FROM sales WHERE product_key IS NOT NULL AND warehouse_key IS NOT NULL
GROUP BY 1, 2, 3, 4 HAVING COALESCE(SUM(quantity), 0) > 0""",
    )
    q["rollup_audit"] = with_ctes(
        SALES,
        body="""
SELECT COUNT(*) AS groups_before, COUNT(*) FILTER (WHERE quantity > 0) AS groups_after,
       COUNT(*) FILTER (WHERE NOT quantity > 0) AS groups_dropped
FROM (SELECT CAST(period AS DATE) AS date, product_key, warehouse_key, COALESCE(SUM(quantity), 0) AS quantity
      FROM sales WHERE product_key IS NOT NULL AND warehouse_key IS NOT NULL GROUP BY 1, 2, 3)""",
    )
    q["dq_missing_counts"] = with_ctes(
        *ALL,
        body="""
SELECT (SELECT COUNT(*) FROM sales s LEFT JOIN dim d ON s.product_key = d.ref_key WHERE d.ref_key IS NULL)
         AS sales_without_name,
       (SELECT COUNT(*) FROM daily x LEFT JOIN weather_daily w ON x.date = w.date WHERE w.temperature IS NULL)
         AS daily_without_temperature""",
    )

    # ---- enrichment
    q["calendar_features"] = with_ctes(
        *ALL,
        body="""
SELECT x.date, x.product_key, x.warehouse_key, x.quantity, CAST(isodow(x.date) - 1 AS INTEGER) AS day_of_week,
       CAST(month(x.date) AS INTEGER) AS month, CAST(dayofyear(x.date) AS INTEGER) AS day_of_year,
       CAST(weekofyear(x.date) AS INTEGER) AS week_of_year,
       CASE WHEN isodow(x.date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN h.date IS NULL THEN 0 ELSE 1 END AS is_holiday
FROM daily x LEFT JOIN holidays h ON x.date = h.date""",
    )
    cyc = []
    for name, expr, period in (
        ("dow", "(isodow(date) - 1)", 7),
        ("month", "month(date)", 12),
        ("doy", "dayofyear(date)", 365),
    ):
        for fn in ("sin", "cos"):
            cyc.append(f"round_even({fn}(2 * pi() * {expr} / {period}.0), 9) AS {name}_{fn}")
    q["cyclic_features"] = with_ctes(*BASE, body=f"SELECT date, product_key, warehouse_key, {', '.join(cyc)} FROM daily")
    q["weather_join_median_fill"] = with_ctes(
        *ALL,
        """
j AS (SELECT x.date, x.product_key, x.warehouse_key, x.quantity, w.temperature, w.precipitation
      FROM daily x LEFT JOIN weather_daily w ON x.date = w.date)""",
        body="""
SELECT date, product_key, warehouse_key, quantity,
       COALESCE(temperature, (SELECT median(temperature) FROM j)) AS temperature,
       COALESCE(precipitation, 0) AS precipitation
FROM j""",
    )
    q["product_category"] = with_ctes(
        *BASE,
        body="""
SELECT x.date, x.product_key, x.warehouse_key, x.product_name, COALESCE(p.description, 'Other') AS category
FROM daily x LEFT JOIN dim c ON x.product_key = c.ref_key LEFT JOIN dim p ON c.parent_key = p.ref_key""",
    )
    q["unit_price"] = with_ctes(
        *BASE,
        body="""
SELECT date, product_key, warehouse_key, quantity, amount,
       CASE WHEN quantity > 0 THEN amount / quantity ELSE 0 END AS avg_price
FROM daily""",
    )

    # ---- series windows
    lags = ", ".join(f"COALESCE(LAG(quantity, {k}) OVER ({SERIES_W}), 0) AS lag_{k}" for k in (1, 7, 14, 30))
    q["series_lags"] = with_ctes(*BASE, body=f"SELECT date, product_key, warehouse_key, quantity, {lags} FROM daily")
    mas = ", ".join(f"COALESCE({trailing('AVG(quantity)', n)}, 0) AS ma_{n}" for n in (7, 14, 30))
    q["series_moving_avg"] = with_ctes(*BASE, body=f"SELECT date, product_key, warehouse_key, quantity, {mas} FROM daily")
    q["series_volatility"] = with_ctes(
        *BASE,
        body=f"""
SELECT date, product_key, warehouse_key, quantity,
       round_even(COALESCE({trailing("STDDEV_SAMP(quantity)", 7)}, 0), 9) AS std_7
FROM daily""",
    )
    q["series_ewma"] = with_ctes(
        *BASE,
        ewma_cte((7, 14)),
        body="""
SELECT date, product_key, warehouse_key, quantity, round_even(ewma_7, 6) AS ewma_7, round_even(ewma_14, 6) AS ewma_14
FROM ewma""",
    )
    q["series_trend"] = with_ctes(
        *BASE,
        f"""
m AS (SELECT date, product_key, warehouse_key, quantity, {trailing("AVG(quantity)", 7)} AS ma7,
             {trailing("AVG(quantity)", 30)} AS ma30 FROM daily)""",
        body="""
SELECT date, product_key, warehouse_key, quantity, CASE WHEN ma30 > 0 THEN ma7 / ma30 ELSE 1.0 END AS trend_7_30
FROM m""",
    )

    ago = "RANGE BETWEEN INTERVAL {} DAY PRECEDING AND INTERVAL {} DAY PRECEDING"
    q["series_calendar_lags"] = with_ctes(
        *BASE,
        body=f"""
SELECT date, product_key, warehouse_key, quantity,
       {", ".join(f"COALESCE(MAX(quantity) OVER ({SERIES_W} {ago.format(k, k)}), 0) AS lag_{k}" for k in (1, 7, 14, 30))},
       {", ".join(f"COALESCE(AVG(quantity) OVER ({SERIES_W} {ago.format(k, 1)}), 0) AS ma_{k}" for k in (7, 14, 30))},
       round_even(COALESCE(STDDEV_SAMP(quantity) OVER ({SERIES_W} {ago.format(7, 1)}), 0), 9) AS std_7
FROM daily""",
    )
    q["series_features_incremental"] = with_ctes(
        *BASE,
        ewma_cte((7, 14)),
        f"""
f AS (SELECT date, product_key, warehouse_key, quantity, {lags}, {mas},
             COALESCE({trailing("STDDEV_SAMP(quantity)", 7)}, 0) AS std,
             {trailing("AVG(quantity)", 7)} AS ma7, {trailing("AVG(quantity)", 30)} AS ma30
      FROM daily)""",
        body=f"""
SELECT date, product_key, warehouse_key, f.quantity, lag_1, lag_7, lag_14, lag_30, ma_7, ma_14, ma_30,
       round_even(std, 9) AS std_7, round_even(ewma_7, 6) AS ewma_7, round_even(ewma_14, 6) AS ewma_14,
       CASE WHEN ma30 > 0 THEN ma7 / ma30 ELSE 1.0 END AS trend_7_30
FROM f JOIN ewma USING (date, product_key, warehouse_key)
WHERE date >= {STATE_CUTOFF}""",
    )

    # ---- reports
    q["daily_totals"] = with_ctes(
        *BASE, body=f"SELECT date, SUM(quantity) AS quantity, {money()} AS amount FROM daily GROUP BY date"
    )
    q["daily_totals_ma7"] = with_ctes(
        *BASE,
        """
t AS (SELECT date, SUM(quantity) AS quantity, SUM(CAST(amount AS DECIMAL(18, 2))) AS amt FROM daily GROUP BY date)""",
        body="""
SELECT date, quantity, CAST(amt AS DOUBLE) AS amount,
       CASE WHEN COUNT(*) OVER w = 7 THEN CAST(SUM(amt) OVER w AS DOUBLE) / 7 END AS amount_ma7,
       CASE WHEN COUNT(*) OVER w = 7 THEN SUM(quantity) OVER w / 7 END AS quantity_ma7
FROM t WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    )
    totals = f"SELECT product_name, SUM(quantity) AS quantity, {money()} AS amount FROM daily GROUP BY product_name"
    q["top_products_by_amount"] = with_ctes(*BASE, body=f"{totals} ORDER BY amount DESC, product_name LIMIT 20")
    q["top_products_by_quantity"] = with_ctes(*BASE, body=f"{totals} ORDER BY quantity DESC, product_name LIMIT 15")
    q["weekday_totals"] = with_ctes(
        *BASE,
        body=f"SELECT CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, SUM(quantity) AS quantity, {money()} AS amount FROM daily GROUP BY 1",
    )
    q["monthly_totals"] = with_ctes(
        *BASE,
        body=f"SELECT strftime(date, '%Y-%m') AS month, SUM(quantity) AS quantity, {money()} AS amount FROM daily GROUP BY 1",
    )
    q["top_product_month_matrix"] = with_ctes(
        *BASE,
        f"""
top AS (SELECT product_name FROM ({totals}) ORDER BY amount DESC, product_name LIMIT 10),
cells AS (SELECT strftime(date, '%Y-%m') AS month, product_name, SUM(quantity) AS quantity
          FROM daily WHERE product_name IN (SELECT product_name FROM top) GROUP BY 1, 2),
months AS (SELECT DISTINCT month FROM cells)""",
        body="""
SELECT m.month, t.product_name, COALESCE(c.quantity, 0) AS quantity
FROM months m CROSS JOIN top t LEFT JOIN cells c ON c.month = m.month AND c.product_name = t.product_name""",
    )
    q["product_summary"] = with_ctes(
        *BASE,
        body=f"""
SELECT product_name, COUNT(DISTINCT date) AS days, SUM(quantity) AS quantity_total, {money()} AS amount_total,
       SUM(quantity) / COUNT(*) AS mean_quantity, {money()} / COUNT(*) AS mean_amount,
       round_even({money()} / SUM(quantity), 1) AS avg_price
FROM daily GROUP BY product_name""",
    )
    q["kpis"] = with_ctes(
        *BASE,
        body=f"""
SELECT MIN(date) AS first_date, MAX(date) AS last_date, COUNT(DISTINCT date) AS days,
       COUNT(DISTINCT product_name) AS products, {money()} AS amount_total, SUM(quantity) AS quantity_total,
       {money()} / COUNT(DISTINCT date) AS mean_daily_amount
FROM daily""",
    )

    # ---- splits, metrics, validation
    summary = "COUNT(*) AS rows, MIN(date) AS first_date, MAX(date) AS last_date, SUM(quantity) AS quantity"
    q["split_counts"] = with_ctes(
        *BASE,
        body=f"""
SELECT CASE WHEN date < {CUTOFF} THEN 'train' ELSE 'validation' END AS split, {summary}
FROM daily GROUP BY 1""",
    )
    q["ordered_split_counts"] = with_ctes(
        *BASE,
        """
o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date, product_key, warehouse_key) AS rn, COUNT(*) OVER () AS n FROM daily)""",
        body=f"""
SELECT CASE WHEN rn <= n - CEIL(CAST(0.2 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split, {summary}
FROM o GROUP BY 1""",
    )
    q["log_target"] = with_ctes(
        *BASE,
        body="""
SELECT date, product_key, warehouse_key, quantity, round_even(ln(1 + quantity), 9) AS log_target,
       round_even(exp(ln(1 + quantity)) - 1, 6) AS back_transformed
FROM daily""",
    )
    q["regression_metrics"] = with_ctes(*BASE, ewma_cte((7,)), NAIVE, body=metrics_select(1, "naive_lag_7", "lag_7"))
    q["model_comparison"] = with_ctes(
        *BASE,
        ewma_cte((7,)),
        NAIVE,
        f"""
log AS ({metrics_select(1, "naive_lag_7", "lag_7")}
  UNION ALL {metrics_select(2, "naive_ma_7", "ma_7")}
  UNION ALL {metrics_select(3, "naive_ma_30", "ma_30")}),
cur AS ({metrics_select(4, "naive_ewma_7", "ewma_7")}),
first AS (SELECT mae FROM log ORDER BY seq LIMIT 1)""",
        body="""
SELECT l.model AS baseline_model, l.mae AS baseline_mae, c.model AS model, c.mae AS mae,
       round_even(c.mae - l.mae, 6) AS delta, round_even(c.mae - f.mae, 6) AS delta_vs_first,
       round_even((c.mae - f.mae) / f.mae * 100, 6) AS pct_vs_first
FROM log l, cur c, first f""",
    )
    q["validation_overall"] = with_ctes(
        *BASE,
        ewma_cte((7,)),
        NAIVE,
        PRED,
        body=f"""
SELECT MIN(date) AS first_date, MAX(date) AS last_date, COUNT(*) AS rows,
       round_even(AVG(ABS(quantity - predicted)), 6) AS mae, SUM(quantity) AS fact_total,
       CAST(SUM(CAST(predicted AS DECIMAL(18, 1))) AS DOUBLE) AS forecast_total,
       round_even((CAST(SUM(CAST(predicted AS DECIMAL(18, 1))) AS DOUBLE) - SUM(quantity)) / SUM(quantity) * 100, 6)
         AS diff_pct
FROM clamped""",
    )
    q["validation_by_product"] = with_ctes(
        *BASE,
        ewma_cte((7,)),
        NAIVE,
        PRED,
        """
p AS (
  SELECT product_name, SUM(quantity) AS fact_raw,
         CAST(SUM(CAST(predicted AS DECIMAL(18, 1))) AS DOUBLE) AS forecast_raw, COUNT(DISTINCT date) AS days,
         CAST(SUM(CAST(ABS(error) AS DECIMAL(18, 1))) AS DOUBLE) / COUNT(error) AS mae_raw
  FROM clamped GROUP BY product_name),
d AS (SELECT *, round_even((forecast_raw - fact_raw) / GREATEST(fact_raw, 1) * 100, 1) AS diff_pct FROM p)""",
        body="""
SELECT product_name, CAST(trunc(fact_raw) AS BIGINT) AS fact, CAST(round_even(forecast_raw, 0) AS BIGINT) AS forecast,
       days, round_even(mae_raw, 1) AS mae_unclamped, diff_pct,
       CASE WHEN ABS(diff_pct) < 15 THEN 'ok' WHEN ABS(diff_pct) < 30 THEN 'warn' ELSE 'bad' END AS status
FROM d""",
    )
    q["validation_from_csv"] = q["validation_by_product"]
    naive = [(1, "naive_lag_7", "lag_7"), (2, "naive_ma_7", "ma_7"), (3, "naive_ma_30", "ma_30"), (4, "naive_ewma_7", "ewma_7")]
    q["metrics_log"] = with_ctes(
        *BASE,
        ewma_cte((7,)),
        NAIVE,
        body=" UNION ALL ".join(
            f"SELECT seq, model, mae, rmse, mape, r2, 'quantity' AS features FROM ({metrics_select(*m)})" for m in naive
        ),
    )
    q["validation_by_day"] = with_ctes(
        *BASE,
        ewma_cte((7,)),
        NAIVE,
        PRED,
        BY_DAY,
        body="""
SELECT date, fact, forecast, diff_pct,
       CASE WHEN ABS(diff_pct) < 10 THEN 'ok' WHEN ABS(diff_pct) < 20 THEN 'warn' ELSE 'bad' END AS status
FROM by_day""",
    )
    q["validation_daily_accuracy"] = with_ctes(
        *BASE,
        ewma_cte((7,)),
        NAIVE,
        PRED,
        BY_DAY,
        body="""
SELECT round_even(AVG(ABS(fact - forecast)), 6) AS daily_mae,
       round_even(CAST(SUM(CAST(ABS(diff_pct) AS DECIMAL(18, 1))) AS DOUBLE) / COUNT(diff_pct), 6) AS daily_mape
FROM by_day""",
    )

    # ---- forecast
    q["recent_sales"] = with_ctes(SALES, recent_cte(45), body="SELECT * FROM recent")
    q["active_series"] = with_ctes(
        SALES, recent_cte(45), body="SELECT product_key, warehouse_key FROM recent GROUP BY 1, 2 HAVING SUM(quantity) > 0"
    )
    q["window_unit_price"] = with_ctes(
        SALES,
        recent_cte(45),
        body=f"SELECT product_key, warehouse_key, {money()} / GREATEST(SUM(quantity), 1) AS avg_price FROM recent GROUP BY 1, 2",
    )
    q["forecast_features"] = with_ctes(SALES, W, serving_cte(45), body=features_body())
    q["forecast_features_400"] = with_ctes(SALES, W, serving_cte(400), body=features_body())
    q["forecast_report"] = with_ctes(
        SALES,
        NOMENCLATURE,
        serving_cte(45),
        """
s AS (SELECT product_key, CAST(round_even(GREATEST(ma_7, 0), 0) AS BIGINT) AS q FROM serving)""",
        body="""
SELECT COALESCE(d.description, 'Unknown') AS product_name, CAST(SUM(s.q) AS BIGINT) AS forecast_qty
FROM s LEFT JOIN dim d ON s.product_key = d.ref_key GROUP BY 1 HAVING SUM(s.q) > 0""",
    )

    q["forecast_report_layout"] = with_ctes(
        SALES,
        NOMENCLATURE,
        W,
        serving_cte(45),
        """
s AS (SELECT product_key, CAST(round_even(GREATEST(ma_7, 0), 0) AS BIGINT) AS q FROM serving),
rep AS (SELECT COALESCE(d.description, 'Unknown') AS product_name, CAST(SUM(s.q) AS BIGINT) AS forecast_qty
        FROM s LEFT JOIN dim d ON s.product_key = d.ref_key GROUP BY 1 HAVING SUM(s.q) > 0)""",
        body=f"""
SELECT substr(product_name, 1, 35) AS product, forecast_qty,
       ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][isodow({TARGET})] AS weekday,
       COALESCE((SELECT temperature FROM weather_daily WHERE date = {TARGET}), 10.0) AS temperature,
       CASE WHEN EXISTS (SELECT 1 FROM holidays WHERE date = {TARGET}) THEN 'yes' ELSE 'no' END AS holiday
FROM rep""",
    )

    # ---- ingestion
    q["week_windows"] = with_ctes(SALES, windows_cte("planned", 0), body="SELECT * FROM planned")
    q["pending_windows"] = with_ctes(
        SALES,
        windows_cte("planned", 14),
        windows_cte("landed", 0),
        body="""
SELECT p.window_start, p.window_end FROM planned p
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.window_start = p.window_start AND l.window_end >= p.window_end)""",
    )
    q["merge_chunks"] = with_ctes(SALES, body="SELECT * FROM sales")
    q["landing_compacted"] = q["merge_chunks"]
    q["parse_sales_json"] = with_ctes(
        SALES, body="SELECT period, product_key, warehouse_key, quantity, amount FROM sales"
    )
    q["parse_weather_json"] = with_ctes(W, body="SELECT * FROM weather_daily")
    q["ingest_available_now"] = with_ctes(SALES, body="SELECT * FROM sales")
    q["ingest_relanded"] = with_ctes(SALES, body="SELECT * FROM sales")

    return q
