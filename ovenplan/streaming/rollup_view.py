"""The daily rollup as a table that follows a landing folder.

The stream of the landing's manifest says which days each new run covered. Only
those are worked out again, each from its latest run, and only their
partitions of the table are replaced; what a run did not cover is neither read
nor written. A day's groups need no other day, so the table always equals the rollup of
:func:`ovenplan.sources.landing.merge_chunks`.

The table holds all groups of :func:`ovenplan.operators.rollup.daily_groups`
(records counted, NULL keys and net returns included), so the rollup, its audit
and the record-level quality counts are all read from it. A day whose groups are
gone keeps one row of 0 records: a dynamic overwrite replaces only partitions
that get a row.

A batch that is repeated after a failure works out the same days again and
leaves the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ovenplan.operators import rollup
from ovenplan.sources import landing as landing_folder
from ovenplan.streaming.ingest import RUNS_PER_TRIGGER

GROUPS = (
    T.StructType()
    .add("product_key", "string")
    .add("warehouse_key", "string")
    .add("records", "long")
    .add("quantity", "double")
    .add("amount", "double")
    .add("date", "date")
)


def changed_days(spark: SparkSession, landing: str, windows: DataFrame) -> list:
    """week, day and latest run of the days in ``windows``; at most one row per calendar day."""
    covered = F.broadcast(landing_folder.days_of(windows).select("day").distinct())
    latest = landing_folder.latest_runs(landing_folder.manifest(spark, landing))
    return latest.join(covered, "day").select("week", "day", "run").collect()


def replace_days(spark: SparkSession, landing: str, table: str, latest: list) -> None:
    """Work out the groups of the days in ``latest`` and replace their partitions of ``table``."""
    groups = rollup.daily_groups(landing_folder.records_of_days(spark, landing, latest))
    empty = spark.createDataFrame([(r.day, 0, 0.0, 0.0) for r in latest], "date date, records long, quantity double, amount double")
    rows = groups.unionByName(empty, allowMissingColumns=True).select(*GROUPS.names)
    write = rows.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write.partitionBy("date").parquet(table)


def refresh_rollup(
    spark: SparkSession, landing: str, table: str, checkpoint: str, runs_per_trigger: int = RUNS_PER_TRIGGER
) -> int:
    """Bring ``table`` up to the runs landed since the last call and stop.

    Returns the number of micro-batches run.
    """
    stream = spark.readStream.schema(landing_folder.MANIFEST).option("maxFilesPerTrigger", runs_per_trigger)

    def take(batch: DataFrame, _: int) -> None:
        latest = changed_days(batch.sparkSession, landing, batch)
        if latest:
            replace_days(batch.sparkSession, landing, table, latest)

    q = (
        stream.parquet(f"{landing}/manifest")
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return len(q.recentProgress)


def read_groups(spark: SparkSession, table: str) -> DataFrame:
    """date, product_key, warehouse_key, records, quantity, amount of every group."""
    rows = spark.read.schema(GROUPS).parquet(table).where(F.col("records") > 0)
    return rows.select("date", "product_key", "warehouse_key", "records", "quantity", "amount")


def read_rollup(spark: SparkSession, table: str, nomenclature: DataFrame | None) -> DataFrame:
    """The named daily rollup, as :func:`ovenplan.operators.rollup.daily_rollup` of all records."""
    return rollup.name_rollup(rollup.keyed_groups(read_groups(spark, table)), nomenclature)
