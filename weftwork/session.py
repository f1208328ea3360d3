"""Session factory, and where checkpoints and scratch tables may be kept."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What every job of this library wants, whatever the cluster. Sizes that depend on the data
# (shuffle partitions, memory) are left to the submitter; AQE coalesces from the initial number.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Stream state on the executors' disks, so that it may outgrow their memory.
_CLUSTER_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.default.parallelism": "8",
    "spark.driver.memory": "8g",
}

_local_scratch: dict[str, str] = {}


def build_session(
    app: str = "weftwork", master: str | None = None, conf: Mapping[str, str] | None = None
) -> SparkSession:
    """A session with the library's settings. ``master`` is given for local runs only."""
    settings = dict(_BASE_CONF)
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings.update(_LOCAL_CONF if (master or "").startswith("local") else _CLUSTER_CONF)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def job_session(app: str, master: str | None = None, conf: Mapping[str, str] | None = None):
    """A session that is stopped when the job is over, also after an error."""
    spark = build_session(app, master, conf)
    try:
        yield spark
    finally:
        spark.stop()


def run_job(app: str, job: Callable[[SparkSession], object], **session_args):
    with job_session(app, **session_args) as spark:
        return job(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors can reach, as the cluster names it in spark.checkpoint.dir.

    A folder of this machine is used only by local sessions, where there is no other machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    already_set = context.getCheckpointDir()
    if already_set:
        return already_set
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app_id = context.applicationId
    if app_id not in _local_scratch:
        _local_scratch[app_id] = tempfile.mkdtemp(prefix="weftwork-")
    return _local_scratch[app_id]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path for a table or stream checkpoint that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table in whatever file system it is."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder with its lineage cut; a lost executor costs no recompute."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def broadcast_bytes(spark: SparkSession) -> int:
    """The size up to which the session broadcasts a side of a join; negative if never."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
