"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

# Results depend on these two.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Plans depend on these. broadcast() is written only for frames with one row per
# calendar date. Every other join side is broadcast only when its size, as estimated
# from the files or measured by AQE, is under autoBroadcastJoinThreshold; beyond that
# the join sorts and AQE splits hot partitions, also where it costs one more shuffle.
PLANNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A write into many date partitions is bound by its files, not its bytes: small
    # stages keep some parallelism instead of shrinking to one task per megabyte.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in {**SEMANTICS, **PLANNING}.items():
        spark.conf.set(key, value)
    # Listing many partition folders: as many tasks as the cores can use, not one per folder.
    spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    return spark


def create_session(app: str = "tallyspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTICS, **PLANNING, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, but only under a local
    master, where driver and executors are one process.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor reaches")
    folder = tempfile.mkdtemp(prefix="tallyspark-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
