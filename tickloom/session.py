"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # State lives off-heap on the executors and is uploaded as changelogs.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else each write and removal looks its key up first, only to report the number of kept rows.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Else each store buffers up to 128 MB of writes for as long as it is open, and an executor has
    # several for each shuffle partition. Together they now take maxMemoryUsageMB, 500 by default.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tickloom-")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    Only a local session may go without that setting; on a cluster a machine-local
    folder would be lost with its executor, so that is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_dir()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
