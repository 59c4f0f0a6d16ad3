"""Session defaults.  Everything here is a plain Spark setting a user could pass to spark-submit."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that the operators count on.  Skewed reduce partitions are split at run time, also where the
# split costs one more exchange; the session runs in UTC because observation times are UTC instants; the state of
# streams lies on the executors' disks instead of their heap.
RUNTIME_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(app: str = "zonelens", cpus: str = "8", **extra: str) -> SparkSession:
    """A session for tests and benches on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **RUNTIME_SETTINGS,
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``.  A machine-local folder is made only where the setting is
    absent and everything runs in one process on one machine; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or ""
    if base:
        return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return os.path.join(tempfile.mkdtemp(prefix=f"zonelens-{purpose}-"), "data")
