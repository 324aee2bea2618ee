"""Product dimension: deduplication, display names and the parent category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Defaults for a product missing from the dimension, for a
# product whose parent folder has no row, and for runs with no dimension.
UNKNOWN_NAME = "Unknown"
OTHER_CATEGORY = "Other"
NO_DIMENSION_CATEGORY = "unknown"


def dedupe(nomenclature: DataFrame) -> DataFrame:
    """One row per ``ref_key``: the row with the smallest (description, parent_key), NULL last.

    A duplicated key would otherwise multiply every fact it joins to. The
    choice is deterministic (independent of file order). Grouping pre-aggregates
    map-side, so a key repeated many times never reaches one task whole.
    """
    nulls_last = [F.col("description").isNull().alias("unnamed"), "description", F.col("parent_key").isNull().alias("rootless"), "parent_key"]
    best = F.min(F.struct(*nulls_last)).alias("best")
    return nomenclature.groupBy("ref_key").agg(best).select(
        "ref_key", F.col("best.description").alias("description"), F.col("best.parent_key").alias("parent_key")
    )


def duplicate_keys(nomenclature: DataFrame) -> DataFrame:
    """Data-quality count: keys occurring more than once."""
    counts = nomenclature.groupBy("ref_key").count()
    return counts.agg(F.count_if(F.col("count") > 1).alias("duplicate_ref_keys"))


def product_names(nomenclature: DataFrame) -> DataFrame:
    """product_key, product_name."""
    return dedupe(nomenclature).select(F.col("ref_key").alias("product_key"), F.col("description").alias("product_name"))


def with_product_name(df: DataFrame, nomenclature: DataFrame | None, unknown: str = UNKNOWN_NAME) -> DataFrame:
    """Left join to the dimension; unmatched keys get ``unknown``; no dimension: name = key."""
    if nomenclature is None:
        return df.withColumn("product_name", F.col("product_key"))
    names = product_names(nomenclature)
    joined = df.join(names, "product_key", "left")
    return joined.withColumn("product_name", F.coalesce(F.col("product_name"), F.lit(unknown)))


def product_categories(nomenclature: DataFrame) -> DataFrame:
    """product_key, category: the description of the product's parent folder.

    The dimension is joined to itself once (child.parent_key = parent.ref_key);
    the result has one row per dimension key.
    """
    d = dedupe(nomenclature)
    child = d.select(F.col("ref_key").alias("product_key"), "parent_key")
    parent = d.select(F.col("ref_key").alias("parent_key"), F.col("description").alias("category"))
    return child.join(parent, "parent_key", "left").select("product_key", "category")


def with_category(
    df: DataFrame,
    nomenclature: DataFrame | None,
    other: str = OTHER_CATEGORY,
    no_dimension: str = NO_DIMENSION_CATEGORY,
) -> DataFrame:
    if nomenclature is None:
        return df.withColumn("category", F.lit(no_dimension))
    joined = df.join(product_categories(nomenclature), "product_key", "left")
    return joined.withColumn("category", F.coalesce(F.col("category"), F.lit(other)))
