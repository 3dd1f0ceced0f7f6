"""Session construction and cluster-wide settings read from the session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. Callers on a cluster normally pass their own
# session; these are only applied by ``get_session`` (tests, bench, local runs).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Reliable checkpoints (keys, folds, id numbering) are removed
    # once nothing references them, so repeated builds do not fill the folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for large clusters (≈100 TB inputs): start shuffles wide and let AQE
# coalesce them to ~256 MB partitions, so no reducer has to hold more than it
# can sort in memory before spilling; split scans at 256 MB; let AQE split
# skewed join partitions. Applied by ``get_session(cluster=True)``; on a real
# cluster these normally live in the job's own configuration.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickspan", extra: dict | None = None,
                cluster: bool = False) -> SparkSession:
    """Build (or fetch) a session with the settings above (plus
    ``CLUSTER_CONF`` when ``cluster``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``. Only in local mode (tests,
    local runs) and only when it is unset, fall back to a fresh scratch
    folder; on a cluster a missing setting is an error, never a machine-local
    folder."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        configured = tempfile.mkdtemp(prefix="tickspan-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (survives executor
    loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df, name: str):
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    lineage is cut, lost executors cost nothing, and readers take only the columns
    that they need. For wide tables that are read more than once; nothing removes
    them but whoever clears the folder."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
