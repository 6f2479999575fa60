"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Streams keep their state on executors' disks, not on their heaps; keyed state can't be in any other store.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)

# What a cluster's session should have as well. Adaptive execution coalesces
# small shuffle partitions and splits skewed join partitions at run time, so
# spark.sql.shuffle.partitions only has to be large enough: input size / 128 MB.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Streamed sessions are merged in each task before they are shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    STATE_STORE[0]: STATE_STORE[1],
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", shared_folder: str | None = None
) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("airtally")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    if shared_folder:
        builder = builder.config("spark.checkpoint.dir", shared_folder)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run under the shared folder the cluster names.

    Only a local master may fall back to a temporary folder of its own: on a
    cluster the executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="airtally-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
