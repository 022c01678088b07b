"""Session helpers: building a local session for tests and bench, and locating
the shared folder where derived tables and checkpoints go."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlake") -> SparkSession:
    """A local session with the settings the library is tested under."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it is set by the operator to a folder every executor can reach; we
    only read it, or the folder given to ``setCheckpointDir``.  Where neither is set,
    a local session (a test, a laptop) gets a local folder; any other session is
    refused, because each machine would write to a disk of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        sc = spark.sparkContext
        own = os.path.join(tempfile.gettempdir(), "ledgerlake-checkpoints")
        given = sc.getCheckpointDir()
        if given and not given.removeprefix("file:").startswith(own):
            return given.rstrip("/")
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not given:
            sc.setCheckpointDir(own)
        d = own
    return d.rstrip("/")


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run, sized from the input and the cluster.

    Shuffle partitions start at the larger of 3 waves of tasks and
    input / target size (AQE then coalesces small ones and splits skewed ones), so a
    partition stays well inside an executor's memory at any scale.  File splits
    match the target size.  Broadcasts stay for bounded tables: the threshold is
    a fixed byte size that Spark checks against statistics and AQE against the
    measured shuffle output."""
    slots = executors * cores_per_executor
    partitions = max(3 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
