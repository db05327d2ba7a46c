"""Session helpers.

The library never owns the cluster: it takes the caller's ``SparkSession`` and
only sets SQL runtime options that make results reproducible.
"""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# SQL options the operators rely on.  Wall-clock features (hour, weekday) and
# durations are computed in UTC so they never depend on the host time zone.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime options to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for materialised intermediate tables.

    On a cluster this must be ``spark.checkpoint.dir`` (a shared file system
    path).  Only when the session names none (tests, local runs) a fresh local
    folder is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store); "
                           "a machine-local folder does not survive executor loss")
    local = tempfile.mkdtemp(prefix="tipscope-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
