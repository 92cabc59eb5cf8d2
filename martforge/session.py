"""Session helpers: the configuration the library assumes, and where it may write.

The library never creates its own cluster settings on a real cluster: it reads
``spark.checkpoint.dir`` from the running session and only falls back to a
scratch directory when the setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package is written against.  AQE re-plans joins
# at runtime (broadcast when a side turns out small, skew-split hot keys) and
# coalesces small shuffle partitions; NTZ timestamps keep wall-clock values
# independent of the session time zone.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
}

# Settings of the warehouse's queries, where the session has none of its own.  A task then
# sorts what fits in its memory at any size of the input: scans are cut fine, and AQE joins
# the exchange's many partitions up to its advisory size, whatever their configured number.
BOUNDED_TASKS_CONF = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "400",
}


def local_session(app: str = "martforge", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARTFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_recommended_conf(spark: SparkSession) -> None:
    """Set the session options the plans rely on (runtime-settable SQL confs only)."""
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)


def apply_bounded_tasks_conf(spark: SparkSession) -> None:
    for k, v in BOUNDED_TASKS_CONF.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and versioned tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local master may leave it
    unset: a scratch directory is then created and registered as the checkpoint
    dir.  On a cluster every executor would write to a disk of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    scratch = tempfile.mkdtemp(prefix="martforge-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch
