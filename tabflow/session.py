"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session can take, also one that was built elsewhere.
RUNTIME_SETTINGS = {
    # An instant has one calendar date everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Parquet keeps min/max of such timestamps (the default INT96 form has none), so
    # that lookups by time skip blocks.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # The JVM never compiles a method of more than 8000 bytes of byte code. Wide rows
    # fused into one stage reach that; as separate operators they run up to twice as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # State of final windows: on executor disk, and only its changes go to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tabflow", **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` adds or overrides.

    AQE sizes the shuffles: start with many small partitions on a cluster
    (``spark.sql.shuffle.partitions`` near input bytes / 128 MB) and let it merge
    them, split skewed joins and split skewed ``rebalance`` partitions.
    """
    settings = {
        **RUNTIME_SETTINGS,
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # Checkpoints go when nothing refers to them any more; by default they stay for ever.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.scheduler.mode": "FAIR",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def own_session(spark: SparkSession) -> SparkSession:
    """A session with the runtime settings beside one that was built elsewhere, whose settings stay as they are.

    Both share the application, the catalog and the cached data. The settings the
    given session has at this moment are taken over.
    """
    own = spark.newSession()
    for key, value in [*spark.conf.getAll.items(), *RUNTIME_SETTINGS.items()]:
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``, which is taken at its word.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local path would be lost with its executor, so that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tabflow-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return os.path.join(shared_dir(spark), "tabflow", f"{name}-{uuid.uuid4().hex[:12]}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder with its files, in any file system Spark can write; nothing if it is absent."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
