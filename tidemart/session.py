"""Session settings and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

TIME_ZONE = "UTC"
ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

_local_roots: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the one time zone in which all event times are read and printed."""
    if spark.conf.get("spark.sql.session.timeZone") != TIME_ZONE:
        spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where the
    driver and the executors share one disk, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tidemart-")
    return _local_roots[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared root that no earlier run has used."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def stream_session(
    spark: SparkSession, state_partitions: int | None = None, idle_batches: bool = True
) -> SparkSession:
    """Session with its own settings for stateful queries.

    Without ``idle_batches`` no micro-batch runs without new rows. State that lives by the clock asks for
    one after another, so a query over it that should stop when all is read needs this.

    The number of state partitions is fixed when a checkpoint is first written, so it
    is chosen per query and not left to the batch setting of the caller's session.
    """
    own = configure(spark.newSession())
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle_batches).lower())
    return own
