"""Adapter: the star-schema test tables seen as the planning data model.

``sales`` is every ``lineitem`` row (a return flag turns it into a negative
record), keyed by part brand (product) and supplier region (warehouse).
The product dimension, the daily weather and the holiday calendar are
derived from the same tables. Every query of the library starts here, so
its work grows with ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Month-day list standing in for a national holiday calendar.
HOLIDAY_MONTH_DAYS = [
    "01-01", "01-02", "01-07", "03-08", "03-21", "03-22", "03-23",
    "05-01", "05-07", "05-09", "07-06", "08-30", "10-25", "12-16",
]

SALE = "sale"

# Schemas of the test tables read here (fixed, so no scan infers them).
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """period, product_key, warehouse_key, quantity, amount, recorder_type."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_shipdate",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # nation has one row per nation (25): a fixed bound, so it is broadcast.
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    supplier_region = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey", "n_regionkey"
    )
    # part and supplier grow with the scale factor: the planner (and AQE at
    # run time, from measured sizes) picks broadcast or sort-merge for them.
    joined = li.join(part, li.l_partkey == part.p_partkey).join(
        supplier_region, li.l_suppkey == supplier_region.s_suppkey
    )
    is_return = F.col("l_returnflag") == "R"
    return joined.select(
        F.col("l_shipdate").cast("timestamp_ntz").alias("period"),
        F.col("p_brand").alias("product_key"),
        F.col("n_regionkey").cast("string").alias("warehouse_key"),
        F.when(is_return, -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("double").alias("quantity"),
        F.when(is_return, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).cast("double").alias("amount"),
        F.when(F.col("l_linestatus") == "F", F.lit(SALE)).otherwise(F.lit("other")).alias("recorder_type"),
    )


def nomenclature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension with folder rows, built from the distinct part brands.

    Deliberately incomplete, as a real catalogue is: brands whose number is a
    multiple of 11 have no item row (their sales get the unknown name), one
    name is shared by two brands, and folder G4 has no row of its own (its
    items get the default category). Facts are never filtered by this.
    """
    brands = (
        table(spark, sf_dir, "part")
        .select(F.col("p_brand").alias("ref_key"))
        .distinct()
        .withColumn("k", F.substring("ref_key", 7, 64).cast("int"))
    )
    k = F.col("k")
    group = (k % 5).cast("string")
    # One pass over the distinct brands emits each brand's item row and its
    # folder row (a NULL key marks a row the catalogue does not have); the
    # final distinct collapses the folder rows shared by several brands.
    item = F.struct(
        F.when(k % 11 != 0, F.col("ref_key")).alias("ref_key"),
        F.when(k == 2, F.lit("Product 1")).otherwise(F.concat(F.lit("Product "), k.cast("string"))).alias("description"),
        F.concat(F.lit("G"), group).alias("parent_key"),
    )
    folder = F.struct(
        F.when(k % 5 != 4, F.concat(F.lit("G"), group)).alias("ref_key"),
        F.concat(F.lit("Group "), group).alias("description"),
        F.lit(None).cast("string").alias("parent_key"),
    )
    rows = brands.select(F.inline(F.array(item, folder)))
    return rows.where(F.col("ref_key").isNotNull()).distinct()


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """date, temperature, precipitation: one row per shipping day, some days absent.

    Day 17 of each month has no row (exercises the median fill) and every
    third day of the month has no precipitation value.
    """
    days = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    dom = F.dayofmonth("date")
    return days.where(dom % 17 != 0).select(
        "date",
        ((F.dayofyear("date") % 50) / F.lit(2.0) - F.lit(10.0)).cast("double").alias("temperature"),
        F.when(dom % 3 == 0, F.lit(None)).otherwise((dom % 7) / F.lit(2.0)).cast("double").alias("precipitation"),
    )


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipping days whose month-day is in :data:`HOLIDAY_MONTH_DAYS`.

    The test is on ``month * 100 + day`` (integers computed from the list):
    the filter runs below the distinct, on every record, so no per-row
    string formatting.
    """
    codes = [int(m) * 100 + int(d) for m, d in (md.split("-") for md in HOLIDAY_MONTH_DAYS)]
    days = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    return days.where((F.month("date") * 100 + F.dayofmonth("date")).isin(codes))
