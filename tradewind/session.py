"""Session settings the jobs rely on, and the shared folder for written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Dimension joins carry no hint: the planner compares the file size of the written dimension with
# the broadcast threshold, and beyond it falls back to a sort-merge join whose hot partitions adaptive
# execution splits. The skew split must also happen when the join output feeds an aggregation on the
# same key, hence "forceOptimizeSkewedJoin".
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}
PARTITION_BYTES = 128 * 1024 * 1024
# Beyond these the driver would hold too much about map outputs; partitions and splits grow instead.
MOST_PARTITIONS, MOST_SPLITS = 50_000, 200_000


def cluster_settings(input_bytes: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Settings for a session over ``input_bytes`` of tables (their compressed file sizes).

    Adaptive execution merges small shuffle partitions but does not split evenly large ones, so the
    number to start from must follow the input: rows unpack to about three times their file size. From some
    2 TB on the number stays and the partitions grow, and from 25 TB on the splits of files grow too.
    """
    partitions = min(max(200, -(-3 * input_bytes // partition_bytes)), MOST_PARTITIONS)
    split = max(partition_bytes, -(-input_bytes // MOST_SPLITS))
    return {
        **SQL_SETTINGS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def local_session(cores: str = "*", app: str = "tradewind", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; its shared folder goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="tradewind-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", folder)
    )
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables, visible to every executor.

    It is the one the cluster names in ``spark.checkpoint.dir``; a session without it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files below a folder, added up by its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
