"""Session builder and the folder for intermediate files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings every operator relies on; none of them is tied to a data size.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "quotelane", master: str | None = None, **extra: str) -> SparkSession:
    """Build a session with the engine's runtime settings.

    ``master`` is left to the launcher unless given; ``extra`` takes Spark settings
    with dots written as double underscores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def stream_settings(spark: SparkSession, partitions: int | None = None, ends: bool = True) -> Iterator[None]:
    """Settings that a stream takes over when it starts, whatever session it starts in; the session's own
    come back after. ``partitions``: into how many parts state is cut, if not the session's number. ``ends``: whether
    a micro-batch without rows follows the last one, for what the watermark closes then; not needed where the
    stream is started again."""
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        # counting the rows of the state costs a lookup at every write
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    if not ends:
        settings["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    with _set(spark, settings):
        yield


def small_disk(spark: SparkSession):
    """Settings under which a query's shuffle files go as it ends, not when the driver next collects its garbage, and
    a stream keeps the state of two micro-batches to go back to, not of a hundred."""
    settings = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.streaming.minBatchesToRetain": "2",
    }
    return _set(spark, settings)


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder for stream checkpoints, state and staged output.

    It lies under ``spark.checkpoint.dir``. A machine-local folder is used only where that
    setting is absent and the whole session is one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/quotelane-{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix=f"quotelane-{label}-")
