"""The four jobs. Each takes streams of messages and returns a writer for ``runner.start``."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
import datetime
import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from tradewind import names
from tradewind.functions.json import read_records, write_records
from tradewind.functions.time import event_date, text_timestamp
from tradewind.operators.keyed import first_per_key
from tradewind.operators.skew import PARTNER_SALT, ROW_SALT, add_all_salts, add_row_salt
from tradewind.plans import change_routing, dau, log_split, orders
from tradewind.schemas import (BASE_PROVINCE, DAU_INFO, ORDER_DETAIL, ORDER_INFO_SOURCE, ORDER_WIDE, PAGE_LOG,
                               USER_INFO)
from tradewind.session import shuffles_freed
from tradewind.sources.keyed_store import KeyedStore
from tradewind.sources.manifest import VERSION, Files, Manifest
from tradewind.sources.tables import read_latest_settled, read_versions, write_batch, write_messages

# Takes the messages of one micro-batch and its number.
Sink = Callable[[DataFrame, int], None]
# Users and provinces for the rows of one micro-batch, read anew for each.
Dimensions = Callable[[SparkSession, DataFrame], tuple[DataFrame, DataFrame]]
# Whether the order's id in a column of this name is in a slice.
Slice = Callable[[str], Column]

DAU_VISIT = T.StructType([*PAGE_LOG.fields, T.StructField("dt", T.StringType())])
DIM_ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("table", "id", "dim_key", "op", "data")]
                       + [T.StructField("ts", T.LongType()), T.StructField("offset", T.LongType())])
# Holds the text of a message that is no complete record.
REJECTED = "rejected"
# Event times beyond these (2000 to 2100, epoch ms) are no times: they would only make folders of days.
EARLIEST, LATEST = 946_684_800_000, 4_102_444_800_000
# Topics of orders and line items whose hold ended without a partner.
UNMATCHED_ORDERS, UNMATCHED_DETAILS = "ORDER_UNMATCHED", "ORDER_DETAIL_UNMATCHED"
FACT = T.StructType([T.StructField("topic", T.StringType()), T.StructField("value", T.StringType())])


def split_stream(lines: DataFrame, suffix: str = names.TOPIC_SUFFIX) -> DataFrame:
    """The raw log as messages of (topic, value), one pass, no state. Every batch's progress reports how
    many messages it made and how many of them are dead letters."""
    messages = log_split.split_messages(log_split.parse(lines), suffix)
    dead = F.col("topic") == names.topic(names.DEAD_LETTER_TOPIC, suffix)
    return messages.observe("log_split", F.count(F.lit(1)).alias("messages"), F.count_if(dead).alias("dead_letters"))


def log_split_job(lines: DataFrame, path: str, suffix: str = names.TOPIC_SUFFIX) -> DataStreamWriter:
    """Split the raw log into a folder per topic. The file sink commits each batch once."""
    return split_stream(lines, suffix).writeStream.format("parquet").partitionBy("topic").option("path", path)


def folder_sink(path: str) -> Sink:
    return lambda messages, batch_id: write_messages(messages, path, batch_id)


def kafka_sink(servers: str) -> Sink:
    def send(messages: DataFrame, batch_id: int) -> None:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").save()

    return send


def _set_aside(batch: DataFrame, dead_to: Sink, batch_id: int, suffix: str) -> DataFrame:
    """Send the rejected messages of a batch to the dead letters; gives the other rows."""
    topic = F.lit(names.topic(names.DEAD_LETTER_TOPIC, suffix))
    dead_to(batch.where(F.col(REJECTED).isNotNull()).select(topic.alias("topic"), F.col(REJECTED).alias("value")), batch_id)
    return batch.where(F.col(REJECTED).isNull()).drop(REJECTED)


def dim_store(spark: SparkSession, path: str) -> KeyedStore:
    """The newest image of every dimension row: by change time, then by stream offset. Deleted rows keep theirs."""
    return KeyedStore(spark, path, DIM_ROW, "dim_key", ["dim_key", "table", "id"], ["ts", "offset"])


def change_routing_job(messages: DataFrame, facts_to: Sink, dim_path: str,
                       control: Callable[[SparkSession], DataFrame] | None = None,
                       suffix: str = names.TOPIC_SUFFIX) -> DataStreamWriter:
    """Route change events: facts and dead letters as messages, dimensions into their table.

    `control` gives the table lists of each batch. A failure repeats a batch: facts are then sent again, dimension
    rows count once. A batch is read once for its messages and once for its dimension rows: nothing holds it in between,
    as it may be larger than the executors' memory.
    """
    dead_topic = names.topic(names.DEAD_LETTER_TOPIC, suffix)

    def route(batch: DataFrame, batch_id: int) -> None:
        with shuffles_freed(batch.sparkSession):
            route_batch(batch, batch_id)

    def route_batch(batch: DataFrame, batch_id: int) -> None:
        events = change_routing.parse(batch)
        if control is None:
            sent, dims = change_routing.fact_messages(events, dead_topic, suffix=suffix), change_routing.dim_route(events)
        else:
            facts, dims = change_routing.listed_names(control(batch.sparkSession))
            sent = change_routing.fact_messages(events, dead_topic, facts, suffix)
            dims = change_routing.dim_route(events, dims)
        facts_to(sent, batch_id)
        dim_store(batch.sparkSession, dim_path).write(dims, batch_id)

    return messages.writeStream.foreachBatch(route)


def dimension_reader(dim_path: str) -> Dimensions:
    """The newest users and provinces of the dimension store that ``change_routing_job`` keeps, looked up by the
    ids that a batch refers to: files that cannot hold one of them are not opened."""

    def read(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        store = dim_store(spark, dim_path)

        def typed(name: str, key: str, schema: T.StructType) -> DataFrame:
            wanted = rows.select(F.concat(F.lit(f"DIM:{name}:"), F.col(key).cast("string")).alias("dim_key"))
            return read_records(store.lookup(wanted), schema, "data")

        return typed("USER_INFO", "user_id", USER_INFO), typed("BASE_PROVINCE", "province_id", BASE_PROVINCE)

    return read


def dau_job(messages: DataFrame, path: str, dimensions: Dimensions | None = None,
            as_of: datetime.date | None = None, dead_to: Sink | None = None,
            suffix: str = names.TOPIC_SUFFIX) -> DataStreamWriter:
    """First visits into the daily table, with dimensions if given.

    The table itself is the state: a device is new for a day if the table does not hold it yet. Restarts
    need no restore, also with a new checkpoint, any lateness is accepted, and a repeated batch writes only
    what its first attempt did not.
    Every batch's progress reports the pages before and after the entry filter.
    `dead_to` takes the messages that are unreadable or lack the device or a plausible time; without it, unreadable ones
    are counted in the progress and left out.
    """
    schema = DAU_VISIT if dimensions is None else DAU_INFO
    pages = read_records(messages, PAGE_LOG, metric="dau_input",
                         complete=F.col("mid").isNotNull() & F.col("ts").between(EARLIEST, LATEST),
                         rejected=REJECTED if dead_to else None)
    good = F.col(REJECTED).isNull() if dead_to else F.lit(True)
    pages = pages.observe("dau_funnel", F.count_if(good).alias("pages"),
                          F.count_if(good & F.col("last_page_id").isNull()).alias("entry_pages"))

    def dedup(batch: DataFrame, batch_id: int) -> None:
        if dead_to is None:
            add_visits(batch, batch_id)
            return
        held = batch.persist()
        try:
            add_visits(_set_aside(held, dead_to, batch_id, suffix), batch_id)
        finally:
            held.unpersist()

    def add_visits(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        visits = dau.first_visits(batch).persist()
        try:
            days = [r["dt"] for r in visits.select("dt").distinct().collect()]
            seen = read_versions(spark, path, schema).where(F.col("dt").isin(days))
            fresh = dau.not_yet_seen(visits, seen)
            if dimensions is not None:
                fresh = dau.enrich(fresh, *dimensions(spark, visits), as_of)
            write_batch(fresh, path, batch_id)
        finally:
            visits.unpersist()

    return pages.writeStream.foreachBatch(dedup)


def read_dau(spark: SparkSession, path: str, enriched: bool = True) -> DataFrame:
    """One row per device and day, the earliest on record."""
    versions = read_versions(spark, path, DAU_INFO if enriched else DAU_VISIT).drop(*VERSION)
    return first_per_key(versions, dau.KEY, ["ts"])


def bounded_dedup(messages: DataFrame, max_disorder: str, salts: int = 8) -> DataFrame:
    """First-seen rows with state that ends: a device of a day is forgotten a day and `max_disorder` after
    the day's end.

    For streams whose disorder is known. Rows of days that far back are dropped. State and watermark go by
    the end of the row's day, as a device counts once a day at whatever hour it comes. The first of the two
    steps keeps one row per device, day and salt, so that a busy device's rows are not all sent to one task.
    """
    pages = dau.entry_pages(read_records(messages, PAGE_LOG, metric="dau_input"))
    day_end = F.date_trunc("day", F.timestamp_millis("ts")) + F.expr("INTERVAL 1 DAY")
    timed = pages.withColumns({"dt": event_date(F.col("ts")), "day_end": day_end})
    timed = timed.withWatermark("day_end", f"24 hours {max_disorder}")
    if salts > 1:
        salted = add_row_salt(timed, salts)
        timed = salted.dropDuplicatesWithinWatermark([*dau.KEY, ROW_SALT]).drop(ROW_SALT)
    return timed.dropDuplicatesWithinWatermark(dau.KEY)


def join_orders(order_messages: DataFrame, detail_messages: DataFrame, max_disorder: str,
                retention: datetime.timedelta = orders.RETENTION, salts: int = 4) -> DataFrame:
    """Stream-stream join of orders and line items created within the retention of each other.

    `max_disorder` is how late a message may come by its creation time; state on both sides is kept for
    that plus the retention. The line items of an order are spread over `salts` state partitions and the
    order's state is kept in each, as nothing splits a stream's hot key later.
    """
    left = orders.with_create_parts(read_records(order_messages, ORDER_INFO_SOURCE, metric="order_input"))
    left = left.withColumn("order_at", text_timestamp(F.col("create_time"))).withWatermark("order_at", max_disorder)
    right = orders.detail_side(read_records(detail_messages, ORDER_DETAIL, metric="detail_input"))
    right = right.withColumn("detail_at", text_timestamp(F.col("d_create_time"))).withWatermark(
        "detail_at", max_disorder)
    held = F.lit(retention)
    condition = ((F.col("id") == F.col("d_order_id"))
                 & (F.col("detail_at") >= F.col("order_at") - held)
                 & (F.col("detail_at") <= F.col("order_at") + held))
    if salts > 1:
        left, right = add_all_salts(left, salts), add_row_salt(right, salts)
        condition = condition & (F.col(ROW_SALT) == F.col(PARTNER_SALT))
    joined = left.join(right, condition, "inner")
    return joined.selectExpr(*orders.wide_columns(joined.columns))


# Line items on record that one slice of the order join reads and shuffles at once.
SLICE_ROWS = 50_000_000


def _in_slice(number: int, count: int, name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(count)) == number


class OrderSides:
    """Orders and line items on record, both looked up by the order's id, and what is due to expire by time."""

    PENDING = T.StructType([T.StructField("side", T.StringType()), T.StructField("id", T.LongType()),
                            T.StructField("order_id", T.LongType()), T.StructField("created", T.LongType())])

    def __init__(self, spark: SparkSession, path: str, retention: datetime.timedelta):
        self.spark, self.path, self.retention = spark, path.rstrip("/"), retention
        self.orders = KeyedStore(spark, f"{path}/orders", ORDER_INFO_SOURCE, "id", ["id"])
        self.details = KeyedStore(spark, f"{path}/details", ORDER_DETAIL, "order_id", ["order_id", "id"])
        self.pending = KeyedStore(spark, f"{path}/pending", self.PENDING, "created", ["created", "side", "id", "order_id"])

    def slices(self) -> list[Slice]:
        """Parts of the orders' ids that are worked on one after the other, so that what a batch has on disk between two of its
        steps does not grow with it: one part for SLICE_ROWS line items on record."""
        count = -(-self.details.rows() // SLICE_ROWS)
        return [functools.partial(_in_slice, number, count) for number in range(count)] if count > 1 else [lambda name: F.lit(True)]

    def concerned(self, new_orders: DataFrame, new_details: DataFrame, batch_id: int, part: Slice) -> DataFrame:
        """The orders of the pairs that a batch completes, one row each: those that are `new` with it, and those on record
        that its line items name."""
        named = new_orders.select("id").unionByName(new_details.select(F.col("order_id").alias("id")))
        return orders.with_create_parts(self.orders.lookup(named.where(part("id")), "new", batch_id, part("id")))

    def pairs(self, concerned: DataFrame, wide: Callable[[DataFrame], DataFrame], batch_id: int, part: Slice) -> DataFrame:
        """The pairs that a batch completes, each once: its orders with all line items on record, which has its own, and its
        line items with the other orders. `wide` adds to the orders, of which there are fewer than of pairs. The line items
        of the orders concerned are read once for both."""
        details = self.details.lookup(concerned.select("id"), "new", batch_id, part("order_id"))
        return orders.order_wide(wide(concerned), details, self.retention, fresh="new")

    @contextmanager
    def settled(self, parts: Iterable[DataFrame]) -> Iterator[DataFrame]:
        """Rows that are used more than once, in a folder for as long as they are. They may come in parts."""
        files, name = Files(self.spark, self.path), f"held-{uuid.uuid4().hex}"
        try:
            for rows in parts:
                rows.write.mode("append").option("compression", "zstd").parquet(f"{self.path}/{name}")
            yield self.spark.read.schema(rows.schema).parquet(f"{self.path}/{name}")
        finally:
            files.delete(name)

    def expire(self, new_orders: DataFrame, new_details: DataFrame, max_disorder: datetime.timedelta,
               sink: Sink, batch_id: int) -> None:
        """Send the rows whose hold ended with this batch, and that have no partner, to the sink.

        A hold ends when a time of creation has been seen that lies the retention and `max_disorder` later. How far
        that went is a mark in the manifest, moved after the sink has the rows, so every row is judged once, also
        over restarts; one that comes after its end is judged in its own batch. What is pending is sorted by time, so
        only files that hold what ends now are read, and what has ended is dropped as runs are merged.
        """
        created = F.unix_seconds(text_timestamp(F.col("create_time"))).alias("created")
        new = new_orders.select(F.lit("orders").alias("side"), "id", F.col("id").alias("order_id"), created).unionByName(
            new_details.select(F.lit("details").alias("side"), "id", "order_id", created)).persist()
        try:
            manifest = Manifest(self.spark, self.path)
            marks = manifest.current()["marks"]
            seen = [t for t in (marks.get("seen"), new.agg(F.max("created")).first()[0]) if t is not None]
            if not seen:
                return
            ended, until = marks.get("ended"), max(seen) - int((self.retention + max_disorder).total_seconds())
            until = max(until, ended) if ended is not None else until
            self.pending.retain = None if ended is None else F.col("created") > ended
            self.pending.write(new, batch_id, unique=True)
            due = self.pending.between(ended, until)
            if ended is not None:
                due = due.unionByName(new.where(F.col("created") <= ended))
            due = due.select("side", "id", "order_id").persist()  # may have a row more than once
            try:
                self._send_unmatched(due, sink, batch_id)
            finally:
                due.unpersist()

            def move(state: dict) -> dict:
                state["marks"] |= {"seen": max(seen), "ended": until}
                return state

            manifest.change(move)
        finally:
            new.unpersist()

    def _send_unmatched(self, due: DataFrame, sink: Sink, batch_id: int) -> None:
        with self.settled(self._unmatched(due.where(part("order_id")), part) for part in self.slices()) as lost:
            sink(lost, batch_id)

    def _unmatched(self, due: DataFrame, part: Slice) -> DataFrame:
        by_side = {side: due.where(F.col("side") == side).select("id") for side in ("orders", "details")}
        # Both stores are read once, for what is due of either side and for its partners. Of these rows those without a partner
        # are few, so it is they that are looked up among the due.
        named = due.select("order_id")
        held_orders = self.orders.lookup(named, within=part("id"))
        # No id is null; said here, both uses of the line items have the same plan, and Spark shuffles them once.
        held_details = self.details.lookup(named, within=part("order_id")).where(F.col("id").isNotNull())
        lost_orders = orders.order_unmatched(held_orders, held_details, self.retention).join(by_side["orders"], "id", "left_semi")
        lost_details = orders.detail_unmatched(held_orders, held_details, self.retention).join(
            by_side["details"], "id", "left_semi").select(*ORDER_DETAIL.fieldNames())
        return write_records(lost_orders).select(F.lit(UNMATCHED_ORDERS).alias("topic"), "value").unionByName(
            write_records(lost_details).select(F.lit(UNMATCHED_DETAILS).alias("topic"), "value"))


def read_unmatched(spark: SparkSession, path: str) -> DataFrame:
    """(topic, value) of the folder sink of expired rows; a repeated batch counts once."""
    return read_versions(spark, path, FACT).select("topic", "value").distinct()


def stored_order_job(order_messages: DataFrame, detail_messages: DataFrame, state: str, path: str,
                     dimensions: Dimensions, as_of: datetime.date | None = None,
                     retention: datetime.timedelta = orders.RETENTION, dead_to: Sink | None = None,
                     unmatched_to: Sink | None = None, max_disorder: datetime.timedelta = datetime.timedelta(0),
                     suffix: str = names.TOPIC_SUFFIX) -> DataStreamWriter:
    """Orders and line items joined whatever their disorder: both sides are kept in stores below `state`, and each
    batch joins its orders with all line items on record and its line items with all orders, within the
    retention of each other. No watermark drops a row.

    Both stores are sorted by the order's id, and a batch opens only files that may hold its ids, so what it reads
    grows with the batch. A repeated batch, or a pair that both joins find, counts once when the table is read.
    `dead_to` takes the messages that are unreadable or lack an id or a time of creation; without it they are left
    out. `unmatched_to` takes orders and line items whose hold ends without a partner, each once (``OrderSides.expire``);
    a partner that comes later still is joined.
    """
    timed = text_timestamp(F.col("create_time")).isNotNull() & F.col("id").isNotNull()
    complete = {"orders": timed, "details": timed & F.col("order_id").isNotNull()}

    def sided(messages: DataFrame, side: str) -> DataFrame:
        return messages.select(F.lit(side).alias("side"), "value")

    def join(batch: DataFrame, batch_id: int) -> None:
        with shuffles_freed(batch.sparkSession):
            join_batch(batch, batch_id)

    def join_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sides = OrderSides(spark, state, retention)
        new, rejects = {}, []
        for side, schema, store in (("orders", ORDER_INFO_SOURCE, sides.orders), ("details", ORDER_DETAIL, sides.details)):
            rows = read_records(batch.where(F.col("side") == side), schema, complete=complete[side], rejected=REJECTED)
            rejects.append(rows.select(REJECTED))
            store.write(rows.where(F.col(REJECTED).isNull()).drop(REJECTED), batch_id)
            # What follows reads the batch's rows from the store, where they are reduced and sorted, and caches none.
            new[side] = store.of_batch(batch_id)
        if dead_to is not None:
            _set_aside(rejects[0].unionByName(rejects[1]), dead_to, batch_id, suffix)
        for part in sides.slices():
            with sides.settled([sides.concerned(new["orders"], new["details"], batch_id, part)]) as concerned:
                users, provinces = dimensions(spark, concerned)
                pairs = sides.pairs(concerned, lambda rows: orders.with_dimensions(rows, users, provinces, as_of), batch_id, part)
                write_batch(pairs.select(*ORDER_WIDE.fieldNames(), F.substring("create_date", 1, 7).alias("create_month")),
                            path, batch_id, "create_month")
        if unmatched_to is not None:
            sides.expire(new["orders"], new["details"], max_disorder, unmatched_to, batch_id)

    both = sided(order_messages, "orders").unionByName(sided(detail_messages, "details"))
    return both.writeStream.foreachBatch(join)


def order_job(pairs: DataFrame, path: str, dimensions: Dimensions, as_of: datetime.date | None = None,
              monthly: bool = False) -> DataStreamWriter:
    """Joined pairs, enriched with the newest dimensions, into the table of the order's day.

    `monthly` folders suit a backlog that covers thousands of thinly filled days.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            if held.count() == 0:  # also fills the cache, whose size then decides the joins below
                return
            users, provinces = dimensions(batch.sparkSession, held)
            wide = orders.with_dimensions(held, users, provinces, as_of).select(*ORDER_WIDE.fieldNames())
            if monthly:
                wide = wide.withColumn("create_month", F.substring("create_date", 1, 7))
            write_batch(wide, path, batch_id, "create_month" if monthly else "create_date")
        finally:
            held.unpersist()

    return pairs.writeStream.foreachBatch(enrich)


def read_orders(spark: SparkSession, path: str, monthly: bool = False) -> DataFrame:
    """One row per line item, order and day; a replayed order's newer pairs replace the older ones. The order is part
    of the key, as line items' ids may be hashes."""
    extra = [T.StructField("create_month", T.StringType())] if monthly else []
    wide = read_latest_settled(spark, path, T.StructType([*ORDER_WIDE.fields, *extra]), ["create_date", "order_id", "detail_id"])
    return wide.drop("create_month")

