"""Session settings the jobs rely on, and the place where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Every one is a runtime SQL setting, so they can be applied to a session that somebody else started.
# No join side is broadcast by hint: the planner broadcasts what its statistics (or the finished shuffle)
# show to be under the threshold, and sort-merge joins the rest, splitting skewed partitions.
# The bytes of a task are compressed columns: a task holds some 25 times as much in rows that it sorts and groups, so larger
# tables must make more tasks and not larger ones.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8MB",
    "spark.sql.files.maxPartitionBytes": "16MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only where none is set and the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="matchlake-checkpoint-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that a lost executor does not restart its history."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint()
