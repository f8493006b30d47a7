"""Session settings and the shared folder for written intermediate data."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

from roadpulse.config import FeedConfig

CHECKPOINT_DIR = "spark.checkpoint.dir"

# The public names of Delta's session extension and catalog.
DELTA_SETTINGS = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}

# RocksDB keeps dedup and window state off the JVM heap, uploads only changes,
# and shares one memory bound among all the state partitions of an executor.
ROCKSDB_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}

# A query whose output does not wait for the watermark needs no batch without data; its state
# is cleaned in the next one that has some.
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
DEDUP_SETTINGS = {**ROCKSDB_SETTINGS, NO_DATA_BATCHES: "false"}


def get_spark(
    app_name: str = "roadpulse",
    *,
    config: FeedConfig | None = None,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    rocksdb_state: bool = False,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """A session for one or more stages.

    The zone is always UTC: ``event_date`` and text timestamps depend on it. Shuffle width is
    left to the cluster unless given; for a stateful query the first run fixes it in the
    checkpoint, so choose it for the state the query will grow to.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        # A task that meets few days keeps one file open per day and need not sort its rows.
        "spark.sql.maxConcurrentOutputFileWriters": "8",
    }
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if config is not None and config.table_format == "delta":
        options.update(DELTA_SETTINGS)
    if rocksdb_state:
        options.update(ROCKSDB_SETTINGS)
    options.update(extra or {})
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the queries started inside, put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def is_local(spark: SparkSession) -> bool:
    """Whether tasks run in this very process, so that its folders are theirs."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def require_shared(spark: SparkSession, places: Mapping[str, str]) -> None:
    """Refuse folders of one machine on a cluster: each executor would write its own disk.

    A ``file:`` folder is taken as shared only if it lies below the one the session names.
    """
    if is_local(spark):
        return
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()

    def full(place: str) -> str:
        path = jvm.org.apache.hadoop.fs.Path(place)
        return path.getFileSystem(hadoop).makeQualified(path).toString()

    shared = f"{full(configured).rstrip('/')}/" if configured else None
    for name, place in places.items():
        where = full(place)
        if where.startswith("file:") and not (shared and f"{where}/".startswith(shared)):
            raise RuntimeError(
                f"{name} is {where}, a folder of one machine; on a cluster name one that all "
                f"executors share, or one below {CHECKPOINT_DIR}"
            )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may fall back to a temporary folder: its executors are threads of
    this very process. On a cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if is_local(spark):
        return tempfile.mkdtemp(prefix="roadpulse-")
    raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten."""
    return f"{shared_root(spark)}/roadpulse/{purpose}-{uuid.uuid4().hex}"
