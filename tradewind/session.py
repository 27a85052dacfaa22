"""Session settings and shared scratch folders."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job wants; all can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Skewed join partitions are split even where that costs one more exchange downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Many days of folders are listed by a bounded number of tasks.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Streaming state on local disk with incremental checkpoints, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Only when a session is built: call sites in error messages cost a few milliseconds per column expression.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


# Most bytes of a file split and of a gathered shuffle partition. Parquet of JSON texts is a tenth of the rows in a task's
# memory, so Spark's defaults (128 and 64 MB) would be a gigabyte and more; a session's smaller setting is kept.
MOST_BYTES = {"spark.sql.files.maxPartitionBytes": 16 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20}
_UNITS = {unit: 1024 ** power for power, unit in enumerate("bkmgtp")}


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgtp]?)b?", text.strip().lower()).groups()
    return int(number) * _UNITS[unit or "b"]


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    for name, most in MOST_BYTES.items():
        if _bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str, default: str) -> Iterator[None]:
    """A session's setting for the queries that run within."""
    before = spark.conf.get(name, default)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_freed(spark: SparkSession):
    """Queries that run within delete their shuffle files as they end. Otherwise these stay until the driver happens to collect
    its garbage: those of all batches of a backlog at once."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false")


def build_session(app_name: str = "tradewind", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_CONF, **STATIC_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tradewind-")


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary folder only on a local master that names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_scratch()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
