"""Spark session and shared-storage helpers.

Everything in the library takes a ``SparkSession`` from the caller. These
helpers only build one for tests/bench and resolve the shared folder used for
sinks and lineage cuts.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings every run relies on (oracle parity and adaptive execution).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "loyalflow") -> SparkSession:
    """Local session for tests and the bench (the UI stays off)."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Pin the settings the library's results depend on (time zone, AQE)."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for sinks and lineage cuts.

    Read from ``spark.checkpoint.dir`` (the cluster's shared storage). Where it is
    unset, a local master (tests) gets a fresh temporary folder; on a cluster that
    is an error.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
            path = tempfile.mkdtemp(prefix="loyalflow-ckpt-")
            spark.conf.set("spark.checkpoint.dir", path)
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique location under the shared folder."""
    base = shared_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


#: Called with every frame whose lineage is cut, before it is written (plan tests hook in here).
ON_CUT: list[Callable[[DataFrame], None]] = []


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss).

    The frame is persisted while the checkpoint is written so the plan runs once
    (an eager checkpoint of an unpersisted frame computes it twice: once for the
    action and again to write the files). The checkpoint keeps the frame's output
    partitioning, so a following join/aggregate on the same keys does not
    re-shuffle it.
    """
    from pyspark import StorageLevel

    shared_dir(df.sparkSession)
    for see in ON_CUT:
        see(df)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist(blocking=False)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: cuts the lineage of large frames
    that are read more than once (columns are pruned and filters pushed into each scan)."""
    for see in ON_CUT:
        see(df)
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Suggested settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions are sized so one partition is about ``target_partition_bytes``
    (never fewer than 2x the cores); adaptive execution coalesces small ones and
    splits skewed ones at runtime; scans read ~256 MB splits.
    """
    parts = max(2 * total_cores, int(input_bytes // target_partition_bytes) + 1)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
