"""Session construction and shared-folder (checkpoint) handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job of the library assumes. AQE re-plans joins from runtime
# shuffle statistics (broadcast when the materialized side is small, skew-join
# splitting for hot keys, partition coalescing); RocksDB keeps streaming state
# off the JVM heap.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "fraudlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library defaults (existing settings win)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach and is
    read, never overridden. Only where it is unset (tests, local runs) is a
    folder of our own set: ``fallback`` or a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not fallback and not spark.sparkContext.master.startswith("local"):
        # a machine-local folder is not reachable by other executors
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = fallback or tempfile.mkdtemp(prefix="fraudlake-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for lineage cuts and state)."""
    return "/".join([checkpoint_root(spark), *[p.strip("/") for p in parts]])


def local_test_session(cores: int = 8) -> SparkSession:
    """Local session used by tests and the bench."""
    spark = build_session(
        master=f"local[{cores}]",
        shuffle_partitions=cores,
        extra_conf={
            "spark.driver.memory": os.environ.get("FRAUDLAKE_DRIVER_MEMORY", "8g"),
            "spark.sql.shuffle.partitions": str(cores),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
