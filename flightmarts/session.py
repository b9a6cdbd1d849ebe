"""Session settings."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a deployment should start from. Partition counts and sizes are starting
# points for adaptive execution, which merges small and splits large partitions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Recording a call site per column expression costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(
    app_name: str = "flightmarts",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Session with the library defaults; ``extra`` overrides any of them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fit_shuffles(
    spark: SparkSession,
    *inputs: DataFrame,
    bytes_per_partition: int = 128_000_000,
    most: int = 40_000,
) -> int:
    """Starts shuffles with as many partitions as suit what ``inputs`` read.

    Adaptive execution merges small partitions but never adds any, so a shuffle
    of large input must start with enough; each shuffle then shrinks to its own
    data. Spark's estimate knows pruned folders and columns, so a refresh of one
    day starts small. ``most`` bounds the map status the driver keeps: beyond it
    partitions grow (100 TB: 2.5 GB each, which sorts and spills) instead of
    their number. ``spark.sql.shuffle.partitions`` stays as it is.
    """
    total = sum(
        int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs
    )
    partitions = min(most, max(1, math.ceil(total / bytes_per_partition)))
    partitions = max(partitions, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    return partitions


def use_utc(spark: SparkSession) -> SparkSession:
    """Hours, days and key texts follow the session zone, so it must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as the cluster names it.

    Only a local session, where driver and executors share one disk, may go
    without: it gets a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if shared and (local or not shared.startswith("file:")):
        return shared
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="flightmarts-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the scratch folder, removed when the driver ends.

    Results are read lazily, so what they rest on must outlive the call that
    wrote it; the file system removes it as the application goes.
    """
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.deleteOnExit(folder)
    return path
