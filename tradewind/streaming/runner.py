"""Starting queries: fixed-interval micro-batches in production, all available data at once in backfills."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tradewind.sources import offsets

INTERVAL = "5 seconds"


# Shuffle partitions of a micro-batch for each core, where a query asks for them.
PARTITIONS_PER_CORE = 4
_PARTITIONS = "spark.sql.shuffle.partitions"


def start(writer: DataStreamWriter, checkpoint: str, available_now: bool = False, interval: str = INTERVAL,
          name: str | None = None, by_cores: SparkSession | None = None) -> StreamingQuery:
    """`by_cores` is the query's session, for one whose batches and state are small beside the session's partitions:
    it gets a few for each core where the session has more, as every partition costs every batch a task, a state store
    and a file. A query keeps the number that its checkpoint began with."""
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(**({"availableNow": True} if available_now else {"processingTime": interval}))
    if by_cores is None:
        return writer.start()
    before = by_cores.conf.get(_PARTITIONS)
    by_cores.conf.set(_PARTITIONS, str(min(int(before), PARTITIONS_PER_CORE * by_cores.sparkContext.defaultParallelism)))
    try:
        return writer.start()  # which takes a copy of the session's settings
    finally:
        by_cores.conf.set(_PARTITIONS, before)


class LedgerListener(StreamingQueryListener):
    """Writes the positions of a query's batches to the ledger once each is committed."""

    def __init__(self, spark: SparkSession, path: str, group_id: str, name: str):
        self.spark, self.path, self.group_id, self.name = spark, path, group_id, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            self.take(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def take(self, progress) -> None:
        offsets.record_progress(self.spark, self.path, self.group_id, json.loads(progress.json))


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for the query to end; its failure is raised here."""
    query.awaitTermination()
    return query


def finish_recorded(query: StreamingQuery, listener: LedgerListener) -> StreamingQuery:
    """As ``finish``, with the ledger up to date when it returns: listeners may hear of the last batch later."""
    finish(query)
    for progress in query.recentProgress:
        listener.take(progress)
    return query


def preview(stream: DataFrame, rows: int = 100) -> DataStreamWriter:
    """Print the first rows of every batch, to watch a stream while working on it."""
    return stream.writeStream.format("console").option("numRows", rows).option("truncate", "false")
