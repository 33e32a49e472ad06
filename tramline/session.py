"""Session helpers.

Everything in this package assumes the session time zone is UTC: event
times are absolute instants, and local transit hours are derived explicitly
with ``from_utc_timestamp(..., 'America/Toronto')``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. They are runtime SQL confs, so they can be
# applied to a session someone else built (the driver's, a notebook's).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


_MARKER = "spark.tramline.configured"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators depend on; idempotent.

    A marker key in the session's own conf makes repeat calls one JVM round
    trip; a new session (new conf) is configured again.
    """
    if spark.conf.get(_MARKER, None) == "true":
        return spark
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    spark.conf.set(_MARKER, "true")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tramline") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TRAMLINE_DRIVER_MEM", "8g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        # Commit only the changed keys each micro-batch instead of snapshotting the store.
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        # one machine: its temporary folder is shared by all there is
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tramline-checkpoint-"))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    This is whatever ``spark.checkpoint.dir`` names (a filesystem that the
    driver and all executors share). There is no fallback: a folder of the
    driver's own would lose its files with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location for a named streaming query, under the shared
    checkpoint folder (so a restarted driver resumes where it stopped)."""
    return f"{checkpoint_root(spark)}/streams/{name}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own through the cluster's filesystem."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
