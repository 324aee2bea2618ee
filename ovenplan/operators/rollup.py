"""Daily rollup: sales records -> product x warehouse x day, returns netted.

The aggregation runs *before* the dimension join. After the rollup a
product's facts are at most one row per (day, warehouse), so even a product
holding a third of all records reaches the join as a few thousand rows, and
the map-side partial aggregate absorbs the raw skew before the shuffle.
The result equals join-then-group because the dimension is deduplicated
first (one name per key).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ovenplan.functions import money_sum, zero_sum
from ovenplan.operators.dimension import UNKNOWN_NAME, with_product_name

SERIES_KEYS = ("product_key", "warehouse_key")


def daily_groups(sales: DataFrame, keys: tuple[str, ...] = SERIES_KEYS) -> DataFrame:
    """All (date, keys) groups of the records, NULL keys included, with the
    record count, net quantity and net amount: the one pass over the records
    that the rollup and the record-level data-quality counts both derive from.
    """
    return sales.groupBy(F.to_date("period").alias("date"), *keys).agg(
        F.count(F.lit(1)).alias("records"),
        zero_sum("quantity").alias("quantity"),
        money_sum("amount").alias("amount"),
    )


def keyed_groups(groups: DataFrame, keys: tuple[str, ...] = SERIES_KEYS) -> DataFrame:
    """Groups with every key present (pandas ``groupby`` drops NULL keys)."""
    out = groups
    for k in keys:
        out = out.where(F.col(k).isNotNull())
    return out.select("date", *keys, "quantity", "amount")


def net_daily(sales: DataFrame, keys: tuple[str, ...] = SERIES_KEYS) -> DataFrame:
    """All (date, keys) groups with net quantity and amount, before the HAVING.

    Records with a NULL key are dropped (pandas ``groupby`` default). An
    all-NULL group sums to 0 (pandas), not NULL (SQL).
    """
    keyed = sales
    for k in keys:
        keyed = keyed.where(F.col(k).isNotNull())
    return keyed.groupBy(F.to_date("period").alias("date"), *keys).agg(
        zero_sum("quantity").alias("quantity"),
        money_sum("amount").alias("amount"),
    )


def daily_sales(sales: DataFrame, keys: tuple[str, ...] = SERIES_KEYS) -> DataFrame:
    """Net-positive groups only: returns netted within a day, net <= 0 dropped."""
    return net_daily(sales, keys).where(F.col("quantity") > 0)


def daily_rollup(sales: DataFrame, nomenclature: DataFrame | None, unknown: str = UNKNOWN_NAME) -> DataFrame:
    """date, product_key, product_name, warehouse_key, quantity, amount."""
    return name_rollup(daily_sales(sales), nomenclature, unknown)


def name_rollup(net: DataFrame, nomenclature: DataFrame | None, unknown: str = UNKNOWN_NAME) -> DataFrame:
    """Net-positive groups (from :func:`daily_sales` or :func:`keyed_groups`) with product names."""
    positive = net.where(F.col("quantity") > 0)
    named = with_product_name(positive, nomenclature, unknown)
    return named.select("date", "product_key", "product_name", "warehouse_key", "quantity", "amount")


def rollup_audit(sales: DataFrame) -> DataFrame:
    """Groups before the net-positive filter, kept, and dropped; one row."""
    groups = net_daily(sales)
    return groups.agg(
        F.count(F.lit(1)).alias("groups_before"),
        F.count_if(F.col("quantity") > 0).alias("groups_after"),
        F.count_if(~(F.col("quantity") > 0)).alias("groups_dropped"),
    )


def records_without_name(sales: DataFrame, nomenclature: DataFrame) -> DataFrame:
    """Sales records whose product has no dimension row (NULL keys included); one row.

    Records are first counted per product key (map-side partial aggregate),
    so the join sees one row per product, not one per record.
    """
    per_key = sales.groupBy("product_key").agg(F.count(F.lit(1)).alias("records"))
    return unnamed_records(per_key, nomenclature)


def unnamed_records(counted: DataFrame, nomenclature: DataFrame) -> DataFrame:
    """Sum of ``records`` over rows whose ``product_key`` has no name in the dimension; one row."""
    per_key = counted.groupBy("product_key").agg(F.sum("records").alias("n"))
    named = nomenclature.where(F.col("description").isNotNull())
    keys = named.select(F.col("ref_key").alias("product_key")).distinct()
    unmatched = per_key.join(keys, "product_key", "left_anti")
    return unmatched.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("sales_without_name"))
