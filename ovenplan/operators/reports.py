"""Sales reports over the daily rollup: totals by day, product, weekday and
month, the top-products-by-month matrix, the product summary and KPIs.

Money is summed as exact cents (:func:`money_sum`), so totals do not depend
on how rows are partitioned. Top-k reports break ties by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ovenplan.functions import day_of_week, money_sum, month_label, round_half_even, units, zero_sum
from ovenplan.operators.ordering import running_before, trailing_sums


def daily_totals(daily: DataFrame) -> DataFrame:
    """date, quantity, amount: company totals per day."""
    return daily.groupBy("date").agg(zero_sum("quantity").alias("quantity"), money_sum("amount").alias("amount"))


def daily_totals_ma7(daily: DataFrame, n: int = 7) -> DataFrame:
    """Company totals per day with the n-day rolling mean (this day and the n-1
    selling days before; NULL until n days), pandas ``rolling(n).mean()``.

    Per-day totals are indexed by date (:func:`running_before`, no single-task
    window) and every day is added to the n windows that contain it. Sums are
    exact (amount in cents), so the mean does not depend on evaluation order.
    """
    totals = daily.groupBy("date").agg(
        zero_sum("quantity").alias("quantity"),
        F.coalesce(F.sum(units("amount", 2)), F.lit(0)).alias("cents"),
    )
    # One row per date already: its position is the count of earlier dates.
    indexed = running_before(totals.withColumn("_one", F.lit(1)), "_one", "idx").select(
        "date", "quantity", "cents", F.col("idx").cast("long").alias("idx")
    )
    windows = trailing_sums(indexed, n, ["quantity", "cents"])
    full = F.col("_cnt") == n
    return windows.select(
        "date",
        "quantity",
        (F.col("cents") / F.lit(100.0)).alias("amount"),
        F.when(full, F.col("_sum_cents") / F.lit(100.0) / F.lit(float(n))).alias(f"amount_ma{n}"),
        F.when(full, F.col("_sum_quantity") / F.lit(float(n))).alias(f"quantity_ma{n}"),
    )


def product_totals(daily: DataFrame) -> DataFrame:
    """product_name, quantity, amount (products sharing a name merge)."""
    return daily.groupBy("product_name").agg(
        zero_sum("quantity").alias("quantity"), money_sum("amount").alias("amount")
    )


def top_products(daily: DataFrame, by: str = "amount", n: int = 20) -> DataFrame:
    """The n products with the largest total ``by``; ties broken by name."""
    return product_totals(daily).orderBy(F.col(by).desc(), F.col("product_name")).limit(n)


def weekday_totals(daily: DataFrame) -> DataFrame:
    """day_of_week (Mon=0), quantity, amount."""
    return daily.groupBy(day_of_week("date").alias("day_of_week")).agg(
        zero_sum("quantity").alias("quantity"), money_sum("amount").alias("amount")
    )


def monthly_totals(daily: DataFrame) -> DataFrame:
    """month (``yyyy-MM``), quantity, amount."""
    return daily.groupBy(month_label("date").alias("month")).agg(
        zero_sum("quantity").alias("quantity"), money_sum("amount").alias("amount")
    )


def top_product_names(daily: DataFrame, n: int = 10, by: str = "amount") -> list[str]:
    """Names of the top-n products (a bounded top-k, collected to pivot on)."""
    return [r.product_name for r in top_products(daily, by, n).select("product_name").collect()]


def product_month_matrix(daily: DataFrame, n: int = 10) -> DataFrame:
    """Month x top-n products quantity matrix (wide: one column per product), missing = 0.

    The column names must be known to build the plan, so the top-n names
    (at most n values) are fetched first; use :func:`product_month_long`
    for a fully lazy plan.
    """
    names = top_product_names(daily, n)
    top = F.broadcast(top_products(daily, "amount", n).select("product_name"))
    cells = daily.join(top, "product_name", "left_semi")
    wide = cells.groupBy(month_label("date").alias("month")).pivot("product_name", names).agg(F.sum("quantity"))
    return wide.fillna(0.0, subset=names)


def product_month_long(daily: DataFrame, n: int = 10) -> DataFrame:
    """The month x top-n matrix in long form: month, product_name, quantity (0 if none).

    Rows are the months in which at least one top-n product sold, times the
    n products. The product list is a scalar subquery (an array of at most
    n names) exploded per month: no cross join, no driver round trip. The
    top-n frame is bounded by n, so it is broadcast to the semi join.
    """
    top = top_products(daily, "amount", n).select("product_name")
    names = top.agg(F.sort_array(F.collect_list("product_name"))).scalar()
    cells = (
        daily.join(F.broadcast(top), "product_name", "left_semi")
        .groupBy(month_label("date").alias("month"), "product_name")
        .agg(F.sum("quantity").alias("quantity"))
    )
    grid = cells.select("month").distinct().select("month", F.explode(names).alias("product_name"))
    return grid.join(cells, ["month", "product_name"], "left").select(
        "month", "product_name", F.coalesce(F.col("quantity"), F.lit(0.0)).alias("quantity")
    )


def product_summary(daily: DataFrame) -> DataFrame:
    """Per product name: selling days, totals, means per rollup row and the average price.

    ``avg_price = round(total amount / total quantity, 1)`` (half to even).
    The means are per rollup row (product x warehouse x day), not per day.
    """
    agg = daily.groupBy("product_name").agg(
        F.count_distinct("date").alias("days"),
        zero_sum("quantity").alias("quantity_total"),
        money_sum("amount").alias("amount_total"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return agg.select(
        "product_name",
        "days",
        "quantity_total",
        "amount_total",
        (F.col("quantity_total") / F.col("_rows")).alias("mean_quantity"),
        (F.col("amount_total") / F.col("_rows")).alias("mean_amount"),
        round_half_even(F.try_divide(F.col("amount_total"), F.col("quantity_total")), 1).alias("avg_price"),
    )


def kpis(daily: DataFrame) -> DataFrame:
    """One row: first/last date, selling days, products, totals, mean amount per day."""
    agg = daily.agg(
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.count_distinct("date").alias("days"),
        F.count_distinct("product_name").alias("products"),
        money_sum("amount").alias("amount_total"),
        zero_sum("quantity").alias("quantity_total"),
    )
    return agg.withColumn("mean_daily_amount", F.try_divide(F.col("amount_total"), F.col("days")))
