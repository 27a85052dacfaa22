"""Run one of the four jobs: ``spark-submit tradewind/app.py JOB --root DIR [--servers HOST:PORT,...]``.

With ``--servers`` messages come from and go to Kafka (its connector package must be given to
spark-submit); without, topics are folders below the root. Dimension, daily-active and order tables,
ledgers and checkpoints are always folders below the root, which all executors must share.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind import names
from tradewind.schemas import record
from tradewind.session import build_session
from tradewind.sources import offsets, topics
from tradewind.sources.manifest import Files
from tradewind.streaming import jobs
from tradewind.streaming.runner import INTERVAL, LedgerListener, finish_recorded, start

# The consumer group of each job.
GROUPS = {"log-split": "ODS_BASE_LOG_GROUP", "change-routing": "ODS_BASE_DB_GROUP", "dau": "DWD_DAU_GROUP",
          "orders": "DWD_ORDER_GROUP"}
JOBS = tuple(GROUPS)


class App:
    def __init__(self, spark: SparkSession, root: str, servers: str | None, suffix: str, max_disorder: str | None = None,
                 control: str | None = None):
        self.spark, self.root, self.servers = spark, root.rstrip("/"), servers
        self.suffix, self.max_disorder, self.control = suffix, max_disorder, control

    def folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def group(self, job: str) -> str:
        return GROUPS[job] + self.suffix

    def read(self, job: str, base: str, written_by: str | None = None) -> DataFrame:
        """The stream of a topic; in folders the topics of one job share that job's output folder. A query without a
        checkpoint starts where the ledger says that the job's group has come."""
        topic = names.topic(base, self.suffix)
        start = offsets.positions(self.spark, self.folder("ledger"), self.group(job))
        if self.servers:
            return topics.read_kafka(self.spark, topics.kafka_options(
                self.servers, topic, {topic: start[topic]} if topic in start else None))
        known = Files(self.spark, self.folder("checkpoint")).names(job)
        since = None if known else start.get(topic, {}).get(0)
        if written_by is None:
            return topics.read_folder(self.spark, self.folder(topic), record("topic partition:int offset:long value"),
                                      topic=topic, since=since)
        return topics.read_folder(self.spark, self.folder(written_by), record("value topic"), topic=topic,
                                  since=since).where(F.col("topic") == topic)

    def table_lists(self, spark: SparkSession) -> DataFrame:
        """(role, table_name) as the control folder has it when a batch begins."""
        return spark.read.schema(record("role table_name")).parquet(self.control)

    def writer(self, job: str):
        if job == "log-split":
            lines = self.read(job, names.ODS_LOG_TOPIC)
            if self.servers:
                messages = jobs.split_stream(lines, self.suffix)
                return topics.write_kafka(messages, self.servers, self.folder("checkpoint/log-split"))
            return jobs.log_split_job(lines, self.folder("log-topics"), self.suffix)
        if job == "change-routing":
            sink = jobs.kafka_sink(self.servers) if self.servers else jobs.folder_sink(self.folder("fact-topics"))
            return jobs.change_routing_job(self.read(job, names.ODS_DB_TOPIC), sink, self.folder("dim"),
                                           self.table_lists if self.control else None, self.suffix)
        dimensions = jobs.dimension_reader(self.folder("dim"))
        dead = jobs.kafka_sink(self.servers) if self.servers else jobs.folder_sink(self.folder(f"{job}-dead-letters"))
        if job == "dau":
            return jobs.dau_job(self.read(job, names.PAGE_TOPIC, "log-topics"), self.folder("dau_info"), dimensions,
                                dead_to=dead, suffix=self.suffix)
        sides = self.read(job, "DWD_ORDER_INFO_I", "fact-topics"), self.read(job, "DWD_ORDER_DETAIL_I", "fact-topics")
        if self.max_disorder is None:
            lost = jobs.kafka_sink(self.servers) if self.servers else jobs.folder_sink(self.folder("order-unmatched"))
            return jobs.stored_order_job(*sides, self.folder("order-sides"), self.folder("order_wide"), dimensions,
                                         dead_to=dead, unmatched_to=lost, suffix=self.suffix)
        pairs = jobs.join_orders(*sides, self.max_disorder)
        return jobs.order_job(pairs, self.folder("order_wide"), dimensions, monthly=True)

    def run(self, job: str, available_now: bool = False, interval: str = INTERVAL) -> None:
        listener = LedgerListener(self.spark, self.folder("ledger"), self.group(job), job)
        self.spark.streams.addListener(listener)
        try:
            finish_recorded(start(self.writer(job), self.folder(f"checkpoint/{job}"), available_now, interval, job), listener)
        finally:
            self.spark.streams.removeListener(listener)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True)
    parser.add_argument("--servers")
    parser.add_argument("--suffix", default=names.TOPIC_SUFFIX)
    parser.add_argument("--max-disorder", help="join orders by stream state that ends, dropping what is later than this")
    parser.add_argument("--control", help="Parquet folder of (role, table_name), role fact or dim, read anew for every batch")
    parser.add_argument("--interval", default=INTERVAL)
    parser.add_argument("--available-now", action="store_true", help="work off what is there and stop")
    args = parser.parse_args()
    logging.basicConfig(level=logging.INFO)
    app = App(build_session(args.job), args.root, args.servers, args.suffix, args.max_disorder, args.control)
    app.run(args.job, args.available_now, args.interval)


if __name__ == "__main__":
    main()
