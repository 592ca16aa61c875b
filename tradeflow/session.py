"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def pin_utc(spark: SparkSession) -> SparkSession:
    """Partition columns and date casts follow the session zone: keep it on UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store its path names."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run on the driver's machine."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables and stream checkpoints.

    On a cluster this is below the shared folder named by
    ``spark.checkpoint.dir``. A local folder serves only a local master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/tradeflow-{purpose}-{uuid.uuid4().hex}"
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"tradeflow-{purpose}-")
