"""Runtime settings the plans rely on, and the folder for job scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

from stampcard.config import EngineConfig

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

RUNTIME_SETTINGS = {
    # Casts between zone-less times and epoch milliseconds use this zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split an oversized join partition even where a later operator then
    # needs one more shuffle: a user or event id may hold a third of the rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # Save what a batch changed, not the whole store, at every batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Without this a bounded run in processing-time mode never ends.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def tune(spark: SparkSession, streaming: bool = False) -> SparkSession:
    """Apply the settings above. The number of shuffle partitions stays the
    cluster's choice; see ``set_parallelism`` for streams."""
    settings = dict(RUNTIME_SETTINGS)
    if streaming:
        settings.update(STREAM_SETTINGS)
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark


def set_parallelism(spark: SparkSession, cfg: EngineConfig) -> SparkSession:
    """Fix a stream's shuffle width. A stateful query keeps the value it was
    first started with, so set it before the first start."""
    spark.conf.set("spark.sql.shuffle.partitions", str(cfg.parallelism))
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stampcard-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for data all executors share. A local
    session without one gets a temporary folder; a cluster must name its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise ValueError("spark.checkpoint.dir is not set; name a folder all executors share")


def job_path(spark: SparkSession, name: str) -> str:
    """A lasting folder for a named job's checkpoint and state."""
    return f"{shared_folder(spark)}/stampcard/{name}"


def lasting_path(spark: SparkSession, name: str) -> str:
    """As ``job_path``, for jobs that go on in another process: a temporary
    folder will not do, so the session must name its shared folder."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        raise ValueError("spark.checkpoint.dir is not set; name a lasting folder all executors share")
    return job_path(spark, name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for a table that only cuts a plan."""
    return f"{shared_folder(spark)}/stampcard/{name}-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, path: str):
    """A path of Hadoop's and the file system it is on."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the jobs' own, on whatever store it is; one that is
    not there is none."""
    where, store = _stored(spark, path)
    store.delete(where, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    where, store = _stored(spark, path)
    if not store.exists(where):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(where))
