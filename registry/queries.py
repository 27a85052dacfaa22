
from __future__ import annotations

from collections.abc import Callable
import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.functions.json import read_records, write_records
from tradewind.functions.text import highlight, matches_any
from tradewind.functions.time import age_years
from tradewind.operators import documents, records
from tradewind.operators.dimensions import with_province, with_user
from tradewind.plans import change_routing, dau, log_split, orders, reports
from tradewind.schemas import DAU_INFO, DAU_MAPPING, ORDER_DETAIL, ORDER_MAPPING, PAGE_LOG
from tradewind.session import new_folder, shuffles_freed, tune
from tradewind.sources import derived, offsets, tables, topics
from tradewind.sources.manifest import Files
from tradewind.streaming import jobs
from tradewind.streaming.runner import finish, start

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = derived.AS_OF
MILLIS_TEXT = "yyyy-MM-dd HH:mm:ss.SSS"
SECONDS_TEXT = "yyyy-MM-dd HH:mm:ss"


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(tune(spark), sf_dir)

    run.__name__ = function.__name__
    run.__doc__ = function.__doc__
    QUERIES[function.__name__] = run
    return function


# --- log split ---------------------------------------------------------------------------------------

def _log(spark: SparkSession, sf_dir: str, *parts: str) -> DataFrame:
    return log_split.parse(derived.raw_log(spark, sf_dir), parts=parts)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_split.page_log(_log(spark, sf_dir, "page"))


@query
def log_error(spark, sf_dir):
    return log_split.error_log(_log(spark, sf_dir))


@query
def log_page(spark, sf_dir):
    return _pages(spark, sf_dir)


@query
def log_display(spark, sf_dir):
    return log_split.display_log(_log(spark, sf_dir, "page", "displays"))


@query
def log_action(spark, sf_dir):
    return log_split.action_log(_log(spark, sf_dir, "page", "actions"))


@query
def log_start(spark, sf_dir):
    return log_split.start_log(_log(spark, sf_dir, "start"))


@query
def log_split_counts(spark, sf_dir):
    messages = log_split.split_messages(_log(spark, sf_dir, *log_split.PARTS))
    return messages.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


@query
def json_roundtrip(spark, sf_dir):
    return read_records(write_records(_pages(spark, sf_dir)), PAGE_LOG)


@query
def keyed_sink_layout(spark, sf_dir):
    """Page messages keyed by device, written by key and read back: what each partition holds."""
    pages = _pages(spark, sf_dir)
    messages = pages.select(F.col("mid").alias("key"), F.to_json(F.struct(*pages.columns)).alias("value"))
    path = new_folder(spark, "keyed")
    topics.write_keyed(messages, path, partitions=16)
    laid_out = spark.read.schema("key string, value string, partition int").parquet(path)
    per_key = laid_out.groupBy("partition", "key").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("partition").agg(F.sum("n").alias("messages"), F.count(F.lit(1)).alias("keys"))


# --- change stream -----------------------------------------------------------------------------------

def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_routing.parse(derived.change_events(spark, sf_dir))


def _row_id(data: str) -> Column:
    return F.get_json_object(data, "$.id").cast("bigint")


@query
def cdc_op(spark, sf_dir):
    events = change_routing.known(_events(spark, sf_dir))
    return events.select("table", _row_id("data").alias("id"), "ts", "type", "op")


def _fact_summary(facts: DataFrame) -> DataFrame:
    found = facts.select("topic", F.json_tuple("value", "id", "total_amount", "split_total_amount", "create_time").alias(
        "id", "total", "split", "create_time"))  # one pass over the text for all four
    return found.select("topic", F.col("id").cast("bigint").alias("id"),
                        F.coalesce("total", "split").cast("double").alias("amount"), "create_time")


@query
def cdc_fact_route(spark, sf_dir):
    return _fact_summary(change_routing.fact_route(_events(spark, sf_dir)))


@query
def cdc_dim_route(spark, sf_dir):
    dims = change_routing.dim_route(_events(spark, sf_dir))
    return dims.select("dim_key", "table", "id", "op", "ts", "data")


@query
def cdc_dynamic_routing(spark, sf_dir):
    """Lists from a control table that has user_info both as a fact and as a dimension."""
    control = spark.createDataFrame(
        [("fact", "order_info"), ("fact", "user_info"), ("dim", "user_info"), ("dim", "base_province")],
        "role string, table_name string")
    facts, dims = change_routing.dynamic_routes(_events(spark, sf_dir), control)
    return facts.select(F.col("topic").alias("target"), F.get_json_object("value", "$.id").alias("id")).unionByName(
        dims.select(F.col("dim_key").alias("target"), "id"))


@query
def dim_latest(spark, sf_dir):
    dims = change_routing.dim_route(_events(spark, sf_dir))
    return change_routing.dim_latest(dims).select("dim_key", "op", "ts", "data")


# --- daily actives -----------------------------------------------------------------------------------

def _dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return derived.user_info(spark, sf_dir), derived.base_province(spark, sf_dir)


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dau.first_visits(_pages(spark, sf_dir))


def _dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dau.enrich(_visits(spark, sf_dir), *_dims(spark, sf_dir), AS_OF)


def _dau_table(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "dau")
    tables.write_batch(_dau(spark, sf_dir), path, 0)
    return path


@query
def dau_entry_pages(spark, sf_dir):
    return dau.entry_pages(_pages(spark, sf_dir))


@query
def dau_dedup(spark, sf_dir):
    return _visits(spark, sf_dir)


@query
def dau_funnel_counts(spark, sf_dir):
    return dau.funnel_counts(_pages(spark, sf_dir))


@query
def user_age(spark, sf_dir):
    users = derived.user_info(spark, sf_dir)
    return users.select("id", "gender", F.col("birthday").cast("string").alias("birthday"),
                        age_years(F.col("birthday"), F.lit(AS_OF)).alias("age"))


@query
def dau_wide(spark, sf_dir):
    return _dau(spark, sf_dir)


@query
def project_by_name(spark, sf_dir):
    return records.project_by_name(_pages(spark, sf_dir), DAU_INFO)


@query
def dau_mapping_cast(spark, sf_dir):
    mapped = records.cast_to_mapping(_dau(spark, sf_dir), DAU_MAPPING)
    return mapped.withColumn("ts", F.date_format("ts", MILLIS_TEXT))


@query
def dau_daily_partitions(spark, sf_dir):
    """The daily table written and read back, with the day as its folder."""
    return jobs.read_dau(spark, _dau_table(spark, sf_dir))


@query
def alias_all_days(spark, sf_dir):
    """The alias over all days, defined in one session and read by its name in another."""
    root = new_folder(spark, "aliases")
    tables.define_alias(spark, root, "dau_info", _dau_table(spark, sf_dir), DAU_INFO, dau.KEY)
    return tables.open_alias(tune(spark.newSession()), root, "dau_info_all").groupBy("dt").agg(
        F.count(F.lit(1)).alias("docs"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query
def search_field(spark, sf_dir):
    """One field of all documents, read from the table as a single column."""
    return documents.search_field(jobs.read_dau(spark, _dau_table(spark, sf_dir)), "mid")


@query
def dau_state_restore(spark, sf_dir):
    """All visits offered again to a table that holds the days before 16 January: only later days are new."""
    visits = _visits(spark, sf_dir)
    path = new_folder(spark, "restore")
    tables.write_batch(visits.where(F.col("dt") < "2024-01-16"), path, 0)
    seen = tables.read_versions(spark, path, jobs.DAU_VISIT)
    return dau.not_yet_seen(visits, seen).select(*visits.columns)


@query
def dau_by_day(spark, sf_dir):
    return reports.dau_by_day(_visits(spark, sf_dir))


@query
def dau_by_hour(spark, sf_dir):
    return reports.dau_by_hour(_dau(spark, sf_dir))


# --- orders ------------------------------------------------------------------------------------------

def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.enrich(derived.order_info(spark, sf_dir), *_dims(spark, sf_dir), AS_OF)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_wide(_orders(spark, sf_dir), derived.order_detail(spark, sf_dir))


def _wide_with(spark: SparkSession, sf_dir: str, add: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs with only the dimension that a report reads."""
    return orders.order_wide(add(derived.order_info(spark, sf_dir)), derived.order_detail(spark, sf_dir))


def _wide_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = derived.user_info(spark, sf_dir)
    return _wide_with(spark, sf_dir, lambda rows: with_user(rows, users, F.lit(AS_OF), "int"))


def _wide_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    provinces = derived.base_province(spark, sf_dir)
    return _wide_with(spark, sf_dir, lambda rows: with_province(rows, provinces, "province_3166_2_code"))


@query
def order_enriched(spark, sf_dir):
    return _orders(spark, sf_dir)


@query
def order_full_outer(spark, sf_dir):
    joined = orders.full_outer(derived.order_info(spark, sf_dir), derived.order_detail(spark, sf_dir))
    return joined.select(F.col("id").alias("order_id"), F.col("d_id").alias("detail_id"),
                         "total_amount", "d_split_total_amount")


@query
def order_wide(spark, sf_dir):
    return _wide(spark, sf_dir)


@query
def order_unmatched(spark, sf_dir):
    return orders.order_unmatched(derived.order_info(spark, sf_dir), derived.order_detail(spark, sf_dir))


@query
def detail_unmatched(spark, sf_dir):
    return orders.detail_unmatched(derived.order_info(spark, sf_dir), derived.order_detail(spark, sf_dir))


@query
def order_mapping_cast(spark, sf_dir):
    mapped = records.cast_to_mapping(_wide(spark, sf_dir), ORDER_MAPPING)
    return mapped.withColumns({c: F.date_format(c, SECONDS_TEXT) for c in (
        "create_time", "operate_time", "expire_time", "refundable_time")})


@query
def order_amount_by_gender(spark, sf_dir):
    return reports.order_amount_by(_wide_by_user(spark, sf_dir), F.col("user_gender"), "user_gender")


@query
def order_amount_by_age_band(spark, sf_dir):
    return reports.order_amount_by(_wide_by_user(spark, sf_dir), reports.age_band(F.col("user_age")), "age_band")


@query
def order_amount_by_province(spark, sf_dir):
    return reports.order_amount_by(_wide_by_province(spark, sf_dir), F.col("province_name"), "province_name")


@query
def order_item_search(spark, sf_dir):
    items = _wide_with(spark, sf_dir, lambda rows: rows)
    return reports.order_item_search(items, "red ring", start=20, size=20)


@query
def category_view(spark, sf_dir):
    return reports.category_view(*derived.categories(spark, sf_dir))


# --- documents ---------------------------------------------------------------------------------------

SEARCH = "red sea"


def _comparable(docs: DataFrame) -> DataFrame:
    """The array as text, since row hashes are taken over scalars."""
    return docs.withColumn("actorList", F.array_join(F.transform("actorList", lambda a: a["name"]), ","))


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derived.docs(spark, sf_dir)
    return docs.where((F.col("imdbScore") >= 5.0) & matches_any(F.col("name"), SEARCH))


def _sort() -> list[Column]:
    return [F.desc("imdbScore"), F.asc("id")]


@query
def bulk_upsert(spark, sf_dir):
    changes = derived.doc_changes(spark, sf_dir)
    return _comparable(documents.bulk_upsert(derived.docs(spark, sf_dir), changes, "id", ["version", "minor"]))


@query
def append_generated_id(spark, sf_dir):
    """All documents posted again without an id: each is there twice, the second time under a new id."""
    docs = derived.docs(spark, sf_dir)
    posted = documents.append_generated_id(docs, docs.drop("id"))
    return _comparable(posted).withColumn("generated", F.length("id") == 36).drop("id")


@query
def update_by_id(spark, sf_dir):
    return _comparable(documents.update_by_id(derived.docs(spark, sf_dir), derived.doc_patches(spark, sf_dir)))


@query
def delete_by_id(spark, sf_dir):
    return _comparable(documents.delete_by_id(derived.docs(spark, sf_dir), derived.returned_ids(spark, sf_dir)))


@query
def update_by_query(spark, sf_dir):
    return _comparable(documents.update_by_query(
        derived.docs(spark, sf_dir), F.col("name") == "red ring", {"name": F.lit("red ring 2")}))


@query
def get_by_id(spark, sf_dir):
    return _comparable(documents.get_by_id(derived.docs(spark, sf_dir), "100"))


@query
def search_filter(spark, sf_dir):
    return _comparable(_hits(spark, sf_dir)).orderBy(*_sort())


@query
def search_highlight(spark, sf_dir):
    hits = _hits(spark, sf_dir)
    return hits.select("id", "name", "imdbScore", highlight(F.col("name"), SEARCH).alias("highlight"))


@query
def search_paging(spark, sf_dir):
    return _comparable(documents.page_of(_hits(spark, sf_dir), _sort(), start=10, size=10))


@query
def search_total_hits(spark, sf_dir):
    return _comparable(documents.page_with_total(_hits(spark, sf_dir), _sort(), start=0, size=2))


@query
def terms_avg_topk(spark, sf_dir):
    docs = derived.docs(spark, sf_dir)
    return documents.terms_avg_topk(docs, F.col("actorList.name"), "imdbScore", 10)


# --- offsets -----------------------------------------------------------------------------------------

@query
def offset_ledger(spark, sf_dir):
    return offsets.batch_end(derived.log_offsets(spark, sf_dir))


@query
def offset_resume(spark, sf_dir):
    """Positions committed and read back as a start position."""
    path = new_folder(spark, "ledger")
    messages = derived.log_offsets(spark, sf_dir)
    offsets.commit(messages, path, "ODS_BASE_LOG_GROUP")
    return offsets.starting_offsets(offsets.committed(spark, path))


@query
def offset_resume_rest(spark, sf_dir):
    """A reader stops before the message at offset 100 of each partition; what a new one then reads from the ledger on."""
    path = new_folder(spark, "ledger")
    messages = derived.log_offsets(spark, sf_dir)
    offsets.commit(messages.where(F.col("offset") < 100), path, "ODS_BASE_LOG_GROUP")
    rest = offsets.not_yet_read(messages, offsets.committed(spark, path))
    return rest.groupBy(*offsets.KEY).agg(F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"),
                                          F.max("offset").alias("last_offset"))


# --- streams -----------------------------------------------------------------------------------------

def _lines_topic(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "log-topic")
    topics.land(derived.raw_log(spark, sf_dir), path)
    return path


def _page_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _pages(spark, sf_dir)
    return pages.select("ts", F.to_json(F.struct(*pages.columns)).alias("value"))


PARTS = 4


class Arrivals:
    """Messages of (part, value) by topic, whose parts arrive one after the other. Each topic is written once, by as
    many tasks as its source has; a part arrives by a rename of its folder."""

    def __init__(self, spark: SparkSession, **messages: DataFrame):
        self.spark, self.root, self.names = spark, new_folder(spark, "arrivals"), list(messages)
        self.files = Files(spark, self.root)
        for name, rows in messages.items():
            with shuffles_freed(spark):
                rows.select("part", "value").write.partitionBy("part").options(**topics.GROUPS).parquet(f"{self.root}/staged/{name}")

    def stream(self, name: str, **options) -> DataFrame:
        return topics.read_folder(self.spark, f"{self.root}/{name}/*", **options)

    def arrive(self, part: int) -> None:
        for name in self.names:
            if f"part={part}" in self.files.names(f"staged/{name}"):
                self.files.move(f"staged/{name}/part={part}", f"{name}/{part}")

    def run(self, make: Callable[[], object], before: Callable[[int], None] = lambda part: None,
            by_cores: bool = False) -> None:
        """Start the job anew for every part, on one checkpoint."""
        checkpoint = new_folder(self.spark, "arrivals-checkpoint")
        for part in range(PARTS):
            before(part)
            self.arrive(part)
            finish(start(make(), checkpoint, available_now=True, by_cores=self.spark if by_cores else None))


def _page_arrivals(spark: SparkSession, sf_dir: str) -> Arrivals:
    """The page messages of the month in four parts, oldest first."""
    begin = [datetime.datetime(2024, 1, day, tzinfo=datetime.timezone.utc).timestamp() * 1000 for day in (9, 17, 25)]
    part = sum((F.col("ts") >= int(at)).cast("int") for at in begin)
    return Arrivals(spark, pages=_page_messages(spark, sf_dir).withColumn("part", part))


def _run(spark: SparkSession, writer, label: str) -> None:
    finish(start(writer, new_folder(spark, label), available_now=True))


@query
def stream_log_split(spark, sf_dir):
    out = new_folder(spark, "split")
    lines = topics.read_folder(spark, _lines_topic(spark, sf_dir))
    _run(spark, jobs.log_split_job(lines, out), "split-checkpoint")
    ts = F.get_json_object("value", "$.ts").cast("bigint")
    messages = spark.read.schema("value string, topic string").parquet(out)
    return messages.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


@query
def stream_change_routing(spark, sf_dir):
    """The change stream through the routing job; what its fact topics and dimension table then hold."""
    topic, facts, dims = (new_folder(spark, n) for n in ("db-topic", "facts", "dims"))
    topics.land(derived.change_events(spark, sf_dir), topic)
    messages = topics.read_folder(spark, topic, spark.read.parquet(topic).schema)
    _run(spark, jobs.change_routing_job(messages, jobs.folder_sink(facts), dims), "db-checkpoint")
    fact_rows = tables.read_versions(spark, facts, jobs.FACT).select(F.col("topic").alias("target"))
    dim_rows = jobs.dim_store(spark, dims).read()
    target = F.concat(F.lit("DIM:"), F.col("table"))
    return fact_rows.unionByName(dim_rows.select(target.alias("target"))).groupBy("target").agg(
        F.count(F.lit(1)).alias("rows"))


@query
def stream_dau_dedup(spark, sf_dir):
    out, pages = new_folder(spark, "dau"), _page_arrivals(spark, sf_dir)
    pages.run(lambda: jobs.dau_job(pages.stream("pages"), out), by_cores=True)
    return jobs.read_dau(spark, out, enriched=False)


@query
def stream_dau_dedup_bounded(spark, sf_dir):
    """The variant with bounded state: which devices were seen on which day."""
    out, pages = new_folder(spark, "dau-bounded"), _page_arrivals(spark, sf_dir)

    def job():
        seen = jobs.bounded_dedup(pages.stream("pages"), "1 hour").select("dt", "mid")
        return seen.writeStream.format("parquet").option("path", out)

    pages.run(job, by_cores=True)
    return spark.read.schema("dt string, mid string").parquet(out)


@query
def stream_dau_wide(spark, sf_dir):
    out, pages = new_folder(spark, "dau-wide"), _page_arrivals(spark, sf_dir)
    pages.run(lambda: jobs.dau_job(pages.stream("pages"), out, lambda s, rows: _dims(s, sf_dir), AS_OF), by_cores=True)
    return jobs.read_dau(spark, out)


@query
def stream_dau_changing_dims(spark, sf_dir):
    """Users change between batches: the routing job feeds the dimension store with the first versions before the first
    part of the month and with the second ones before the third, and each part sees what is there when it comes."""
    out, dims, db, facts = (new_folder(spark, n) for n in ("dau-dims", "dims", "db-topic", "facts"))
    checkpoint, pages = new_folder(spark, "db-checkpoint"), _page_arrivals(spark, sf_dir)
    events = derived.change_events(spark, sf_dir, ("user_info", "base_province"))

    def change(part: int) -> None:
        if part in (0, 2):
            topics.land(events.where(F.col("offset") == (1 if part == 0 else 2)), db)
            messages = topics.read_folder(spark, db, events.schema)
            finish(start(jobs.change_routing_job(messages, jobs.folder_sink(facts), dims), checkpoint, available_now=True))

    pages.run(lambda: jobs.dau_job(pages.stream("pages"), out, jobs.dimension_reader(dims), AS_OF), change, by_cores=True)
    return jobs.read_dau(spark, out)


@query
def stream_restart(spark, sf_dir):
    """The job is stopped half-way through the month and started again on the same checkpoint, then once
    more with everything sent a second time: the table ends as if it had run once."""
    topic, out, checkpoint = (new_folder(spark, n) for n in ("page-topic", "dau", "dau-checkpoint"))
    messages = _page_messages(spark, sf_dir)
    half = F.lit(int(datetime.datetime(2024, 1, 16, tzinfo=datetime.timezone.utc).timestamp() * 1000))
    for part in (messages.where(F.col("ts") < half), messages.where(F.col("ts") >= half), messages):
        topics.land(part, topic)
        job = jobs.dau_job(topics.read_folder(spark, topic), out)
        finish(start(job, checkpoint, available_now=True))
    return jobs.read_dau(spark, out, enriched=False)


def _order_messages(spark: SparkSession, sf_dir: str, part: Column) -> dict[str, DataFrame]:
    """Orders and line items as messages, dealt to parts by `part`."""
    rows = {"orders": derived.order_info(spark, sf_dir), "details": derived.order_detail(spark, sf_dir)}
    return {name: side.select(part.alias("part"), F.to_json(F.struct(*side.columns)).alias("value"))
            for name, side in rows.items()}


@query
def stream_order_join(spark, sf_dir):
    """Orders and line items in four micro-batches, in no order of time."""
    sides, out = new_folder(spark, "order-sides"), new_folder(spark, "order-wide")
    arrivals = Arrivals(spark, **_order_messages(spark, sf_dir, F.pmod(F.xxhash64("id"), F.lit(PARTS))))
    arrivals.run(lambda: jobs.stored_order_job(arrivals.stream("orders"), arrivals.stream("details"), sides, out,
                                               lambda s, rows: _dims(s, sf_dir), AS_OF))
    return jobs.read_orders(spark, out, monthly=True)


@query
def stream_order_new_checkpoint(spark, sf_dir):
    """As above, then every seventh order once more with a changed amount, through a query with a new checkpoint."""
    sides, out = new_folder(spark, "order-sides"), new_folder(spark, "order-wide")
    arrivals = Arrivals(spark, **_order_messages(spark, sf_dir, F.pmod(F.xxhash64("id"), F.lit(PARTS))))

    def job(orders_from: DataFrame, details_from: DataFrame):
        return jobs.stored_order_job(orders_from, details_from, sides, out, lambda s, rows: _dims(s, sf_dir), AS_OF)

    arrivals.run(lambda: job(arrivals.stream("orders"), arrivals.stream("details")))
    again, none = new_folder(spark, "order-topic"), new_folder(spark, "detail-topic")
    changed = derived.order_info(spark, sf_dir).where(F.col("id") % 7 == 0).withColumn("total_amount", F.col("total_amount") + 1000)
    topics.land(write_records(changed), again)
    topics.land(write_records(derived.order_detail(spark, sf_dir).limit(0), ORDER_DETAIL.fieldNames()), none)
    _run(spark, job(topics.read_folder(spark, again), topics.read_folder(spark, none)), "order-checkpoint")
    return jobs.read_orders(spark, out, monthly=True)


@query
def stream_unmatched(spark, sf_dir):
    """Orders and line items in order of time, the query started anew for each of four parts: those whose hold ended
    without a partner, which the job reports once each."""
    sides, out, lost = (new_folder(spark, n) for n in ("order-sides", "order-wide", "order-unmatched"))
    part = sum((F.col("create_time") >= day).cast("int") for day in ("1994-01-01", "1996-01-01", "1997-06-01"))
    arrivals = Arrivals(spark, **_order_messages(spark, sf_dir, part))
    arrivals.run(lambda: jobs.stored_order_job(
        arrivals.stream("orders"), arrivals.stream("details"), sides, out, lambda s, rows: _dims(s, sf_dir), AS_OF,
        unmatched_to=jobs.folder_sink(lost)))
    return jobs.read_unmatched(spark, lost).select("topic", _row_id("value").alias("id"))


@query
def stream_new_checkpoint(spark, sf_dir):
    """The daily job run over the first half of the month, then over all of it with a new checkpoint: the
    table ends as if it had run once."""
    topic, out = new_folder(spark, "page-topic"), new_folder(spark, "dau")
    messages = _page_messages(spark, sf_dir)
    half = F.lit(int(datetime.datetime(2024, 1, 16, tzinfo=datetime.timezone.utc).timestamp() * 1000))
    for number, part in enumerate((messages.where(F.col("ts") < half), messages.where(F.col("ts") >= half))):
        topics.land(part, topic)
        job = jobs.dau_job(topics.read_folder(spark, topic), out)
        finish(start(job, new_folder(spark, f"dau-checkpoint-{number}"), available_now=True))
    return jobs.read_dau(spark, out, enriched=False)
