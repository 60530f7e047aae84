"""Session construction and shared-folder helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Timestamps are stored as TIMESTAMP_NTZ holding UTC wall time, so
# results do not depend on the zone; the zone is pinned only for the few LTZ casts at stream edges.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size of AQE partitions, hence of files written behind a REBALANCE: ~128 MB parquet.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.mergeSchema": "false",
    "spark.ui.enabled": "false",
    # Streaming state (de-dup keys, open hours) kept in RocksDB, off the JVM heap, so state
    # size tracks the watermark window, not executor memory. Chosen before a query's first
    # checkpoint; an existing checkpoint keeps the provider it was created with.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "stationlake", extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the library defaults.

    On a cluster pass nothing for ``master`` and size ``shuffle_partitions`` to the data
    (AQE coalesces small partitions at run time, so erring high is cheap).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session (it is static: fixed when the application starts). Only
    on a local master, as in unit tests, may it be absent: then a fresh local folder is made and
    registered as the context's checkpoint folder. On a cluster a folder of the driver's disk would
    be invisible to the executors, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stationlake-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared checkpoint root for one run of ``name``.

    It holds intermediate tables that a returned DataFrame still reads, so it cannot go when the
    call returns; it is removed when the application ends, on whatever file system it is.
    """
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/stationlake/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return path
