"""Session settings and the shared folder for intermediate tables."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# State that outgrows executor heap (deduplication keys) stays on local disk
# with its change log in the query's checkpoint.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# A store that stays loaded holds tens of megabytes outside the heap, and an executor has one
# for each state partition it was given, and those of earlier runs until they are cleared. A
# run that takes all there is at once closes each as its task ends, so that only the stores
# of running tasks are open. Others keep them, as they would load them again on every trigger.
CLOSED_STATE_CONF = {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}
# A store that counts its rows looks each up before it is written.
UNCOUNTED_STATE_CONF = {
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}

DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog":
        "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def build_session(app_name, master=None, table_format="parquet", conf=None):
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_CONF, **STATE_STORE_CONF}
    if table_format == "delta":
        settings.update(DELTA_CONF)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def session_conf(spark, settings):
    """Apply settings for the length of a block, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# Files that a task reads, for steps that sort or hold whole rows: narrow columns of many
# rows take little room in a file and ten times as much or more in a task.
SHORT_TASKS = {"spark.sql.files.maxPartitionBytes": str(32 << 20)}
# The same for steps that group several rows made of each one. A row group of a file is
# not divided.
SMALL_TASKS = {"spark.sql.files.maxPartitionBytes": str(4 << 20)}


def work_dir(spark, label):
    """A new folder under spark.checkpoint.dir, readable by every executor."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark):
    """Let iterative fits cut their lineage; a folder already set is kept."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_dir(spark, "lineage"))
