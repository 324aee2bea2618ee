"""Session settings and the shared working folder.

Library functions never create a session; tests and ``bench.py`` call
:func:`local_session`. Anything written mid-job (landing chunks, stream
checkpoints, lineage cuts) goes under :func:`shared_dir`, which is the
cluster's ``spark.checkpoint.dir``. A local folder is used only when that
setting is unset, as in tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a cluster job wants as well: AQE re-plans joins from real sizes
# (broadcast only when the built side is measured small), splits skewed
# partitions and coalesces small ones.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ovenplan") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("OVENPLAN_DRIVER_MEMORY", "16g"))
        # Small local inputs: keep CPU-bound stages (windows) spread over the
        # cores instead of coalescing a few MB of shuffle into 2-3 tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    for k, v in CLUSTER_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Unset, a local session gets a temporary folder; on a cluster that would
    be each machine's own disk, so it is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[[^\]]*\])?$", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="ovenplan-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run of one job."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Frees the shuffle files of an execution once it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to ``path`` and read it back; the write's shuffle files go once it has ended.

    Later steps read the table, never the shuffle files, which otherwise stay on the
    executors' disks until the driver's next full collection. While the write runs a lost
    executor's shuffle files are worked out again as usual.
    """
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    For a frame that later steps read more than once (each use would
    otherwise re-run its whole plan, and Catalyst prunes each use differently,
    so exchanges are not shared). The written table cuts the lineage: a lost
    executor re-reads files instead of replaying the plan, and reads get
    column pruning and filter pushdown.
    """
    return write_once(df, shared_dir(df.sparkSession, name))


class Scratch:
    """The tables of one job under the shared folder, each dropped once no frame in use reads it."""

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.root = spark, shared_dir(spark, job)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        return write_once(df, f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables; what was derived from them must have been written before."""
        for name in names:
            remove(self.spark, f"{self.root}/{name}")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job wrote under the shared folder and no frame in use reads any more."""
    if not path.startswith(checkpoint_root(spark) + "/"):
        raise ValueError(f"{path} is not under the shared folder")
    delete_folder(spark, path)
