"""Incremental ingest of landed sales files with Structured Streaming.

The file source remembers which files it has read in its checkpoint, so a
re-run processes only newly landed files. :func:`ingest_landed` follows the
manifest of a landing folder and copies each new run, so a window that was
landed again replaces its earlier records in the ingested table too.
:func:`ingest_available_now` appends the files of a folder in which no record
comes twice. ``trigger(availableNow=True)`` drains what is there in
bounded micro-batches and stops, which is what a scheduled batch job wants.
The checkpoint and the output must live in a shared folder
(:func:`ovenplan.session.shared_dir`), so a lost driver resumes where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ovenplan.schemas import SALES
from ovenplan.sources import landing as landing_folder

#: Files that one micro-batch takes at most.
FILES_PER_TRIGGER = 1000
#: Landing runs (manifest files) that one micro-batch takes at most.
RUNS_PER_TRIGGER = 10


def sales_stream(spark: SparkSession, landing: str, max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    return spark.readStream.schema(SALES).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing)


def ingest_available_now(
    spark: SparkSession,
    landing: str,
    output: str,
    checkpoint: str,
    max_files_per_trigger: int = FILES_PER_TRIGGER,
) -> int:
    """Append every not-yet-ingested landed record to ``output`` and stop.

    Returns the number of micro-batches run.
    """
    stream = sales_stream(spark, landing, max_files_per_trigger)
    q = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(output)
    )
    q.awaitTermination()
    return len(q.recentProgress)


def read_ingested(spark: SparkSession, output: str) -> DataFrame:
    """Batch view of the ingested records (only files committed by the sink's log)."""
    return spark.read.schema(SALES).parquet(output)


def ingest_landed(
    spark: SparkSession, landing: str, output: str, checkpoint: str, runs_per_trigger: int = RUNS_PER_TRIGGER
) -> int:
    """Copy every not-yet-ingested run of a landing folder to ``output`` and stop.

    ``output`` has a landing folder's layout: ``landing.merge_chunks`` reads it. A
    micro-batch overwrites the partitions of its own runs, records before
    manifest, so one that is repeated after a failure leaves the same table.

    Returns the number of micro-batches run.
    """
    stream = spark.readStream.schema(landing_folder.MANIFEST).option("maxFilesPerTrigger", runs_per_trigger)

    def take(batch: DataFrame, _: int) -> None:
        # At most ``runs_per_trigger`` runs: broadcast.
        runs = F.broadcast(batch.select("run").distinct())
        rows = landing_folder.landed_records(batch.sparkSession, landing).join(runs, "run")
        for df, name, keys in ((rows.hint("rebalance", "run", "week"), "data", ["run", "week"]), (batch, "manifest", ["run"])):
            write = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            write.partitionBy(*keys).parquet(f"{output}/{name}")

    q = (
        stream.parquet(f"{landing}/manifest")
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return len(q.recentProgress)
