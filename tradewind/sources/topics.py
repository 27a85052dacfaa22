"""Message topics: Kafka where its connector is installed, folders of Parquet messages elsewhere."""

from __future__ import annotations

from collections.abc import Mapping
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tradewind.schemas import MESSAGE
from tradewind.session import MOST_BYTES, shuffles_freed
from tradewind.sources import offsets

# Milliseconds that a folder topic is read again behind a position taken from the ledger.
OVERLAP = 600_000
# Files of messages have row groups of a read's split: a split of a larger group would take all of it, the others nothing.
GROUPS = {"parquet.block.size": str(MOST_BYTES["spark.sql.files.maxPartitionBytes"] // 2), "compression": "zstd"}


def kafka_options(servers: str, topics: str, start: Mapping[str, Mapping[str, int]] | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Options of a Kafka read. `start` (topic -> partition -> next offset) only counts on a first start;
    from then on the query's checkpoint does. Partitions it leaves out begin at the newest message."""
    if start:
        start = {t: {str(p): o for p, o in parts.items()} for t, parts in start.items()}
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics,
               "startingOffsets": json.dumps(start) if start else "latest", "failOnDataLoss": "true"}
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select("topic", "partition", "offset", "timestamp",
                      F.col("key").cast("string"), F.col("value").cast("string"))


def write_kafka(messages: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    """Rows of (topic, value), with a `key` where messages of one key must stay in one partition."""
    return (messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("kafka.acks", "all").option("kafka.enable.idempotence", "true")
            .option("checkpointLocation", checkpoint))


def read_folder(spark: SparkSession, path: str, schema: T.StructType = MESSAGE,
                files_per_trigger: int | None = None, topic: str | None = None, since: int | None = None) -> DataFrame:
    """A folder of message files as a stream; `files_per_trigger` bounds one micro-batch.

    With `topic`, every batch's progress reports the position reached, the time of change of the newest file in epoch
    milliseconds. `since` is the position at which a first start begins: files changed up to OVERLAP before it are
    read once more, as files of one write do not appear in the order of their times.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    messages = reader.parquet(path)
    if topic is None and since is None:
        return messages
    changed = F.unix_millis("_metadata.file_modification_time")
    if since is not None:
        messages = messages.where(changed >= since - OVERLAP)
    if topic is not None:
        messages = messages.withColumn("_changed", changed).observe(
            offsets.FOLDER_METRIC + topic, F.max("_changed").alias("newest")).drop("_changed")
    return messages


def land(messages: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Add messages to a folder topic, one file or more per task, without a shuffle."""
    with shuffles_freed(messages.sparkSession):
        messages.write.mode("append").option("maxRecordsPerFile", rows_per_file).options(**GROUPS).parquet(path)


def key_partition(key: Column, partitions: int) -> Column:
    """The partition of a key, the same for every message of it."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(partitions)).cast("int")


def write_keyed(messages: DataFrame, path: str, partitions: int, key: str = "key") -> None:
    """Folder topic laid out by key. Rows are gathered per partition and oversized partitions are split
    over several files, so a hot key makes more files and not one long task."""
    placed = messages.withColumn("partition", key_partition(F.col(key), partitions))
    placed.hint("rebalance", "partition").write.mode("append").partitionBy("partition").parquet(path)
