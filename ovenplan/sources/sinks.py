"""Sinks: Parquet overwrite, partitioned overwrite, CSV reports, append-only metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ovenplan.schemas import METRICS


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet dataset; with ``partition_by`` only the partitions written are replaced.

    A partitioned write is rebalanced on the partition columns first (AQE
    sizes the files), so each output partition gets a few right-sized files.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_csv_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV. ``single_file`` is for small reports only (one task writes it)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Append training runs to the metrics log, each once.

    A run (``seq``) is a partition of the log that the write replaces: a run written again,
    after a failure or by a retried job, leaves one copy. Other runs are not read or
    written. :func:`read_metrics` reads the log.
    """
    write = metrics.repartition("seq").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write.partitionBy("seq").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics log, with the columns of ``schemas.METRICS`` in its order."""
    return spark.read.schema(METRICS).parquet(path).select(*METRICS.names)
