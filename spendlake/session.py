"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime re-planning does the skew work: a hot partition of a join is split
# even when that costs a later shuffle, and small partitions are merged.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of one hot key are alike and shrink well: many fit into few bytes.
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings the plans of this package are written for."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, but only in local
    mode: on a cluster a folder of one machine would lose data with it.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="spendlake-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/spendlake/{name}-{uuid.uuid4().hex}"
