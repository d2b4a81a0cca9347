"""Session defaults and the shared scratch location.

Everything that has to land on storage between jobs (streaming checkpoints,
intermediate tables, round-trip writes) goes under the directory the cluster
names in ``spark.checkpoint.dir``. Only when that is unset (local runs, tests)
do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC so event-time arithmetic is zone-free,
# ANSI so bad casts fail loudly (operators use try_* where null is wanted),
# AQE so shuffle partition counts and join strategies adapt to measured sizes.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # what a Python worker holds at a time: rows of whole texts
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting point for a large cluster (~100 TB inputs): many shuffle partitions
# that AQE coalesces to the advisory size, large input splits, skew-join
# splitting of oversized partitions, broadcast only for measured small sides,
# and RocksDB for streaming state (keyed lag, de-duplication) that outgrows
# executor heaps.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "marketpulse",
                shuffle_partitions: int | None = None,
                driver_memory: str | None = None,
                extra: dict | None = None, profile: str = "local") -> SparkSession:
    """``profile="cluster"`` adds ``CLUSTER_DEFAULTS``; explicit arguments win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if profile == "cluster":
        conf.update(CLUSTER_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_defaults(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``marketpulse`` importable in the Python workers (pandas UDFs,
    ``applyInPandasWithState``) by zipping it once per application and
    adding it with ``addPyFile``; Spark distributes it to every executor."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    # a driver-local file: addPyFile copies it to every executor
    target_dir = tempfile.mkdtemp(prefix="marketpulse-py-")
    path = os.path.join(target_dir, f"marketpulse-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Set the SQL defaults on an existing session (e.g. the driver's)."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory, as the session names it.

    Only a local master may run without one (a temporary folder is made
    then); on a cluster a driver-local folder would not be seen by the
    executors, so that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver "
                             "and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="marketpulse-chk-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def is_local(master: str) -> bool:
    """True when driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path (a URI as the session gives it) under the shared
    checkpoint directory."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to a fresh table in the shared folder and reads it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
