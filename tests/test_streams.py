import datetime
import json

import pytest
from pyspark.sql import functions as F, types as T

from tests.test_dau import MIDNIGHT, page, pages
from tests.test_orders import ids, make_details, make_orders, text
from tradewind.functions.json import write_records
from tradewind.plans import dau
from tradewind.schemas import PAGE_LOG, record
from tradewind.sources import derived, offsets, tables, topics
from tradewind.streaming import jobs
from tradewind.streaming.runner import LedgerListener, finish, finish_recorded, start

SF = "/root/testdata/sf0.001"
DAY = 24 * 3600 * 1000


def run(writer, tmp_path, name="checkpoint"):
    return finish(start(writer, f"{tmp_path}/{name}", available_now=True))


def dims(spark, rows):
    return derived.user_info(spark, SF), derived.base_province(spark, SF)


def test_dau_over_batches_with_late_data(spark, tmp_path):
    topic, out = f"{tmp_path}/topic", f"{tmp_path}/dau"
    batches = [[page("a", MIDNIGHT + 5), page("b", MIDNIGHT)],
               [page("a", MIDNIGHT + 1), page("a", MIDNIGHT + DAY), page("c", MIDNIGHT)],
               [page("a", MIDNIGHT - 30 * DAY), page("b", MIDNIGHT + 2)]]
    for batch in batches:
        topics.land(write_records(pages(spark, *batch)), topic)
        run(jobs.dau_job(topics.read_folder(spark, topic), out), tmp_path)
    got = [(r["dt"], r["mid"], r["ts"]) for r in jobs.read_dau(spark, out, enriched=False).collect()]
    assert sorted(got) == [("2023-12-03", "a", MIDNIGHT - 30 * DAY), ("2024-01-02", "a", MIDNIGHT + 5),
                           ("2024-01-02", "b", MIDNIGHT), ("2024-01-02", "c", MIDNIGHT),
                           ("2024-01-03", "a", MIDNIGHT + DAY)]


def test_progress_counts_the_funnel_and_unreadable_messages(spark, tmp_path):
    topic = f"{tmp_path}/topic"
    messages = write_records(pages(spark, page("a", MIDNIGHT), page("b", MIDNIGHT, last_page_id="home")))
    topics.land(messages.union(spark.createDataFrame([("{broken",), ("",)], "value string")).coalesce(1), topic)
    query = run(jobs.dau_job(topics.read_folder(spark, topic), f"{tmp_path}/dau"), tmp_path)
    seen = query.lastProgress["observedMetrics"]
    assert seen["dau_input"].asDict() == {"messages": 4, "unreadable": 2}
    assert seen["dau_funnel"].asDict() == {"pages": 2, "entry_pages": 1}
    assert jobs.read_dau(spark, f"{tmp_path}/dau", enriched=False).count() == 1


def test_repeated_batch_counts_once(spark, tmp_path):
    out = f"{tmp_path}/dau"
    visits = dau.first_visits(pages(spark, page("a", MIDNIGHT), page("b", MIDNIGHT)))
    for _ in range(2):
        tables.write_batch(visits, out, 3)
    assert jobs.read_dau(spark, out, enriched=False).count() == 2
    assert tables.read_versions(spark, out, jobs.DAU_VISIT).count() == 4


def test_absent_table_is_empty(spark, tmp_path):
    assert jobs.read_dau(spark, f"{tmp_path}/nowhere").count() == 0


def test_aliases_outlive_their_session(spark, tmp_path):
    out, root = f"{tmp_path}/dau", f"{tmp_path}/aliases"
    visits = dau.first_visits(pages(spark, page("a", MIDNIGHT), page("a", MIDNIGHT - 1)))
    tables.write_batch(visits, out, 0)
    tables.write_batch(visits.where("dt = '2024-01-02'").withColumn("brand", F.lit("newer")), out, 1)
    tables.define_alias(spark, root, "visits", out, jobs.DAU_VISIT, dau.KEY)
    other = spark.newSession()
    assert tables.open_alias(other, root, "visits_all").count() == 2
    day = tables.open_alias(other, root, "visits_20240102_query")
    assert [(r["mid"], r["brand"]) for r in day.collect()] == [("a", "newer")]
    assert all("dt=2024-01-02" in name for name in day.inputFiles())
    assert tables.open_alias(other, root, "visits_20300102_query").count() == 0
    assert tables.register_aliases(other, root) == ["visits_all"]
    plan = other.sql("SELECT count(*) FROM visits_all WHERE dt = '2024-01-02'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "ReadSchema: struct<mid:string>" in plan
    with pytest.raises(KeyError):
        tables.open_alias(other, root, "nothing_all")


def test_compacted_days_read_the_same(spark, tmp_path):
    out = f"{tmp_path}/dau"
    for batch in range(5):
        tables.write_batch(dau.first_visits(pages(spark, page("a", MIDNIGHT + batch), page(f"m{batch}", MIDNIGHT))), out, batch)
    before = sorted(map(tuple, tables.read_latest(spark, out, jobs.DAU_VISIT, dau.KEY).collect()), key=repr)
    reader = tables.read_latest(spark, out, jobs.DAU_VISIT, dau.KEY)
    for grace in (3600, 0):
        tables.compact_days(spark, out, jobs.DAU_VISIT, dau.KEY, ["2024-01-02", "2030-01-01"], grace=grace)
        assert sorted(map(tuple, tables.read_latest(spark, out, jobs.DAU_VISIT, dau.KEY).collect()), key=repr) == before
        if grace:
            assert reader.count() == len(before) == 6
    tables.compact_days(spark, out, jobs.DAU_VISIT, dau.KEY, [], grace=0)
    names = [n for n in tables.Files(spark, out).names("dt=2024-01-02") if n.endswith(".parquet")]
    assert len(names) == 1
    assert sorted(map(tuple, tables.read_latest(spark, out, jobs.DAU_VISIT, dau.KEY).collect()), key=repr) == before


def test_each_batch_sees_the_newest_dimensions(spark, tmp_path):
    """Change events feed the dimension table while the daily job runs on it."""
    db, facts, store = (f"{tmp_path}/{n}" for n in ("db", "facts", "store"))
    log, out = f"{tmp_path}/log", f"{tmp_path}/dau"
    schema = record("value offset:long")

    def change(gender, ts):
        event = {"type": "update", "table": "user_info", "ts": ts,
                 "data": {"id": 1, "gender": gender, "birthday": "1990-01-02"}}
        topics.land(spark.createDataFrame([(json.dumps(event), ts)], schema), db)
        run(jobs.change_routing_job(topics.read_folder(spark, db, schema), jobs.folder_sink(facts), store), tmp_path, "db-checkpoint")

    for mid, gender, ts in (("a", "M", 1), ("b", "F", 2)):
        change(gender, ts)
        topics.land(write_records(pages(spark, page(mid, MIDNIGHT))), log)
        job = jobs.dau_job(topics.read_folder(spark, log), out, jobs.dimension_reader(store), datetime.date(2024, 1, 1))
        run(job, tmp_path, "log-checkpoint")
    rows = {r["mid"]: (r["user_gender"], r["user_age"]) for r in jobs.read_dau(spark, out).collect()}
    assert rows == {"a": ("M", "33"), "b": ("F", "33")}


def test_table_lists_are_read_anew_for_every_batch(spark, tmp_path):
    db, facts, store, ledger = (f"{tmp_path}/{n}" for n in ("db", "facts", "store", "ledger"))
    schema = record("topic partition:int offset:long value")
    listed = {"table": "order_info"}

    def control(session):
        return session.createDataFrame([("fact", listed["table"])], "role string, table_name string")

    for offset, table in ((0, "order_info"), (1, "cart_info")):
        listed["table"] = table
        events = [json.dumps({"type": "insert", "table": t, "ts": 1, "data": {"id": offset}})
                  for t in ("order_info", "cart_info")]
        topics.land(spark.createDataFrame([("db", 0, 2 * offset + i, e) for i, e in enumerate(events)], schema), db)
        job = jobs.change_routing_job(topics.read_folder(spark, db, schema, topic="db"), jobs.folder_sink(facts), store, control)
        query = start(job, f"{tmp_path}/checkpoint", available_now=True, name="routing")
        finish_recorded(query, LedgerListener(spark, ledger, "g", "routing"))
    got = {(r["topic"], json.loads(r["value"])["id"]) for r in tables.read_versions(spark, facts, jobs.FACT).collect()}
    assert got == {("DWD_ORDER_INFO_I_1018", 0), ("DWD_CART_INFO_I_1018", 1)}
    [(topic, group, partition, newest)] = [tuple(r) for r in offsets.committed(spark, ledger).collect()]
    assert (topic, group, partition) == ("db", "g", 0) and newest > 1_700_000_000_000
    start_json = offsets.starting_offsets(offsets.committed(spark, ledger)).first()["starting_offsets"]
    assert json.loads(start_json) == {"db": {"0": newest}}


def test_routing_holds_no_batch(spark, tmp_path):
    """Nothing is cached while a batch goes to its sink: it may be larger than the executors' memory."""
    held, sent = [], []
    spark.catalog.clearCache()

    def sink(messages, batch_id):
        sent.extend(messages.collect())
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())

    event = json.dumps({"type": "insert", "table": "order_info", "ts": 1, "data": {"id": 1}})
    topics.land(spark.createDataFrame([(event, 1), ("{broken", 2)], "value string, offset long"), f"{tmp_path}/db")
    messages = topics.read_folder(spark, f"{tmp_path}/db", spark.read.parquet(f"{tmp_path}/db").schema)
    run(jobs.change_routing_job(messages, sink, f"{tmp_path}/dims"), tmp_path)
    assert held == [0] and len(sent) == 2


def test_reading_goes_on_from_the_committed_position(spark, tmp_path):
    messages = derived.log_offsets(spark, SF)
    first = messages.where((F.col("offset") < 100) & (F.col("partition") < 3))
    for _ in range(2):
        offsets.commit(first, f"{tmp_path}/ledger", "ODS_BASE_LOG_GROUP")
    rest = offsets.not_yet_read(messages, offsets.committed(spark, f"{tmp_path}/ledger"))
    assert rest.count() == messages.count() - first.count()
    assert rest.where("partition = 3").count() == messages.where("partition = 3").count()


def test_order_join_across_batches(spark, tmp_path):
    order_topic, detail_topic, out = (f"{tmp_path}/{n}" for n in ("orders", "details", "wide"))
    batches = [([(1, text())], []),
               ([], [(10, 1, text(1)), (20, 2, text(1))]),
               ([(2, text(2))], [(11, 1, text(24)), (12, 1, text(24, 1))]),
               ([(1, text())], [])]  # the first order once more
    topics.land(write_records(make_orders(spark)), order_topic)
    topics.land(write_records(make_details(spark)), detail_topic)
    for order_rows, detail_rows in batches:
        if order_rows:
            topics.land(write_records(make_orders(spark, *order_rows)), order_topic)
        if detail_rows:
            topics.land(write_records(make_details(spark, *detail_rows)), detail_topic)
        pairs = jobs.join_orders(topics.read_folder(spark, order_topic), topics.read_folder(spark, detail_topic),
                                 "2 days", salts=3)
        run(jobs.order_job(pairs, out, dims, datetime.date(2024, 6, 30)), tmp_path)
    wide = jobs.read_orders(spark, out)
    assert ids(wide, "detail_id", "order_id", "create_date") == [
        (10, 1, "2024-05-01"), (11, 1, "2024-05-01"), (20, 2, "2024-05-01")]
    assert all(r["user_gender"] for r in wide.collect())


@pytest.mark.parametrize("salts", [1, 3])
def test_bounded_dedup_over_batches(spark, tmp_path, salts):
    topic, out = f"{tmp_path}/topic", f"{tmp_path}/seen"
    # The last page is three days late and beyond the bound: it is dropped.
    batches = [[page("a", MIDNIGHT), page("a", MIDNIGHT + 1)], [page("a", MIDNIGHT + 2), page("b", MIDNIGHT + 3)],
               [page("a", MIDNIGHT + 4 * DAY)], [page("z", MIDNIGHT)]]
    for batch in batches:
        topics.land(write_records(pages(spark, *batch)), topic)
        seen = jobs.bounded_dedup(topics.read_folder(spark, topic), "1 day", salts).select("dt", "mid")
        run(seen.writeStream.format("parquet").option("path", out), tmp_path)
    got = sorted(map(tuple, spark.read.schema("dt string, mid string").parquet(out).collect()))
    assert got == [("2024-01-02", "a"), ("2024-01-02", "b"), ("2024-01-06", "a")]


def test_kafka_options():
    options = topics.kafka_options("h:9092", "t", {"t": {0: 5}}, min_partitions=64)
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 5}} and options["minPartitions"] == "64"
    assert topics.kafka_options("h:9092", "t")["startingOffsets"] == "latest"


def test_page_schema_survives_the_topic(spark):
    from tradewind.functions.json import read_records

    original = pages(spark, page("a", MIDNIGHT, during_time=3))
    assert read_records(write_records(original), PAGE_LOG).collect() == original.collect()


def test_orders_join_in_any_order_of_batches(spark, tmp_path):
    """Interleaved days, years apart, one file a batch: nothing is late."""
    order_topic, detail_topic, out = (f"{tmp_path}/{n}" for n in ("orders", "details", "wide"))
    batches = [([(1, text(24 * 400))], [(20, 2, text(1))]),
               ([(3, text(24 * 31))], [(10, 1, text(24 * 400 + 1)), (30, 3, text(24 * 32))]),
               ([(2, text())], [(11, 1, text(24 * 401)), (12, 1, text(24 * 401, 1)), (31, 3, text(24 * 30))])]
    for order_rows, detail_rows in batches:
        topics.land(write_records(make_orders(spark, *order_rows)).coalesce(1), order_topic)
        topics.land(write_records(make_details(spark, *detail_rows)).coalesce(1), detail_topic)
    for _ in range(2):  # the second run has nothing left to read
        streams = [topics.read_folder(spark, topic, files_per_trigger=1) for topic in (order_topic, detail_topic)]
        run(jobs.stored_order_job(*streams, f"{tmp_path}/sides", out, dims, datetime.date(2024, 6, 30)), tmp_path)
    wide = jobs.read_orders(spark, out, monthly=True)
    assert sorted(r["detail_id"] for r in wide.collect()) == [10, 11, 20, 30, 31]


@pytest.mark.parametrize("salts", [1, 3])
def test_bounded_dedup_counts_a_device_once_a_day(spark, tmp_path, salts):
    hour, topic, out = 3600 * 1000, f"{tmp_path}/topic", f"{tmp_path}/seen"
    for batch in ([page("a", MIDNIGHT)], [page("b", MIDNIGHT + 5 * hour)], [page("a", MIDNIGHT + 7 * hour)],
                  [page("c", MIDNIGHT + 25 * hour)], [page("a", MIDNIGHT + 23 * hour), page("d", MIDNIGHT + 23 * hour)]):
        topics.land(write_records(pages(spark, *batch)), topic)
        seen = jobs.bounded_dedup(topics.read_folder(spark, topic), "1 hour", salts).select("dt", "mid")
        run(seen.writeStream.format("parquet").option("path", out), tmp_path)
    got = sorted(map(tuple, spark.read.schema("dt string, mid string").parquet(out).collect()))
    assert got == [("2024-01-02", "a"), ("2024-01-02", "b"), ("2024-01-02", "d"), ("2024-01-03", "c")]


def test_a_new_checkpoint_keeps_the_first_visit(spark, tmp_path):
    hour, out = 3600 * 1000, f"{tmp_path}/dau"
    for number, at in enumerate((10, 11)):
        topics.land(write_records(pages(spark, page("a", MIDNIGHT + at * hour), page(None, MIDNIGHT + at * hour))),
                    f"{tmp_path}/topic-{number}")
        run(jobs.dau_job(topics.read_folder(spark, f"{tmp_path}/topic-{number}"), out), tmp_path, f"checkpoint-{number}")
    got = [(r["mid"], r["ts"]) for r in jobs.read_dau(spark, out, enriched=False).collect()]
    assert sorted(got, key=str) == [("a", MIDNIGHT + 10 * hour), (None, MIDNIGHT + 10 * hour)]


def test_of_several_patches_one_counts(spark):
    from tradewind.operators.documents import update_by_id

    target = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    patches = spark.createDataFrame([("1", "x"), ("1", "y"), ("3", "z")], "id string, name string")
    assert sorted(map(tuple, update_by_id(target, patches).collect())) == [("1", "y"), ("2", "b")]


def test_incomplete_pages_go_to_the_dead_letters(spark, tmp_path):
    topic, out, dead = (f"{tmp_path}/{n}" for n in ("topic", "dau", "dead"))
    good = write_records(pages(spark, page("a", MIDNIGHT), page(None, MIDNIGHT), page("b", None)))
    topics.land(good.union(spark.createDataFrame([("{broken",), (None,)], "value string")).coalesce(1), topic)
    job = jobs.dau_job(topics.read_folder(spark, topic), out, dead_to=jobs.folder_sink(dead))
    seen = run(job, tmp_path).lastProgress["observedMetrics"]
    assert seen["dau_funnel"].asDict() == {"pages": 1, "entry_pages": 1}
    assert [r["mid"] for r in jobs.read_dau(spark, out, enriched=False).collect()] == ["a"]
    values = {r["value"] for r in tables.read_versions(spark, dead, jobs.FACT).collect()}
    assert len(values) == 4 and {"{broken", ""} < values


def test_incomplete_orders_go_to_the_dead_letters(spark, tmp_path):
    order_topic, detail_topic, out, dead = (f"{tmp_path}/{n}" for n in ("orders", "details", "wide", "dead"))
    broken = spark.createDataFrame([("{broken",), ('{"id": 7}',)], "value string")
    topics.land(write_records(make_orders(spark, (1, text()))).union(broken), order_topic)
    topics.land(write_records(make_details(spark, (10, 1, text()))).union(broken), detail_topic)
    streams = [topics.read_folder(spark, topic) for topic in (order_topic, detail_topic)]
    run(jobs.stored_order_job(*streams, f"{tmp_path}/sides", out, dims, datetime.date(2024, 6, 30),
                              dead_to=jobs.folder_sink(dead)), tmp_path)
    assert [r["detail_id"] for r in jobs.read_orders(spark, out, monthly=True).collect()] == [10]
    assert sorted(r["value"] for r in tables.read_versions(spark, dead, jobs.FACT).collect()) == ['{"id": 7}'] * 2 + ["{broken"] * 2


def test_positions_of_a_group(spark, tmp_path):
    messages = spark.createDataFrame([("t", 0, 4), ("t", 1, 9), ("t", 0, 5)], "topic string, partition int, offset long")
    offsets.commit(messages, f"{tmp_path}/ledger", "g")
    assert offsets.positions(spark, f"{tmp_path}/ledger", "g") == {"t": {0: 6, 1: 10}}
    assert offsets.positions(spark, f"{tmp_path}/ledger", "other") == {} == offsets.positions(spark, f"{tmp_path}/none", "g")


def test_kafka_progress_moves_the_ledger_forward(spark, tmp_path):
    path = f"{tmp_path}/ledger"

    def batch(**ends):
        end = json.dumps({"t": ends})
        return {"sources": [{"endOffset": end}, {"endOffset": {"logOffset": 4}}, {"endOffset": None}], "observedMetrics": {}}

    offsets.record_progress(spark, path, "g", batch(**{"0": 5, "1": 7}))
    offsets.record_progress(spark, path, "g", batch(**{"0": 9, "1": 6}))
    offsets.record_progress(spark, path, "other", batch(**{"0": 1}))
    assert offsets.positions(spark, path, "g") == {"t": {0: 9, 1: 7}}
    assert offsets.committed(spark, path).count() == 3


def test_a_new_query_starts_at_the_ledgers_position(spark, tmp_path):
    """Files changed long before the position are left out; those in the overlap are read again."""
    import os

    topic, seen = f"{tmp_path}/topic", []
    for number in range(3):
        spark.createDataFrame([(str(number),)], "value string").coalesce(1).write.mode("append").parquet(topic)
        for name in os.listdir(topic):
            if name.endswith(".parquet") and name not in seen:
                os.utime(f"{topic}/{name}", (1_700_000_000 + 1000 * number,) * 2)
                seen.append(name)
    since = 1_700_000_000_000 + 2_000_000
    rows = topics.read_folder(spark, topic, topic="t", since=since).select("value")
    out = f"{tmp_path}/out"
    query = start(rows.writeStream.format("parquet").option("path", out), f"{tmp_path}/checkpoint", available_now=True, name="new")
    finish_recorded(query, LedgerListener(spark, f"{tmp_path}/ledger", "g", "new"))
    assert [r["value"] for r in spark.read.parquet(out).collect()] == ["2"]
    assert offsets.positions(spark, f"{tmp_path}/ledger", "g") == {"t": {0: since}}


def test_expired_rows_are_reported_once_over_batches_and_restarts(spark, tmp_path):
    order_topic, detail_topic, out, lost = (f"{tmp_path}/{n}" for n in ("orders", "details", "wide", "lost"))
    batches = [([(1, text()), (2, text())], [(20, 2, text(1)), (30, 3, text(2))]),
               ([(4, text(40))], []),                     # the holds of order 1 and line item 30 end
               ([(5, text(5))], [(60, 6, text(100))]),    # order 5 comes after its end; the hold of order 4 ends
               ([(6, text(99))], [(50, 5, text(6))])]     # a partner for order 5, too late to take the report back
    for order_rows, detail_rows in batches:
        for _ in range(2):
            for rows, topic, make in ((order_rows, order_topic, make_orders), (detail_rows, detail_topic, make_details)):
                topics.land(write_records(make(spark, *rows)).coalesce(1), topic) if _ == 0 else None
            streams = [topics.read_folder(spark, topic) for topic in (order_topic, detail_topic)]
            run(jobs.stored_order_job(*streams, f"{tmp_path}/sides", out, dims, datetime.date(2024, 6, 30),
                                      unmatched_to=jobs.folder_sink(lost)), tmp_path)
    got = sorted((r["topic"], json.loads(r["value"])["id"]) for r in tables.read_versions(spark, lost, jobs.FACT).collect())
    assert got == [("ORDER_DETAIL_UNMATCHED", 30), ("ORDER_UNMATCHED", 1), ("ORDER_UNMATCHED", 4), ("ORDER_UNMATCHED", 5)]
    assert sorted(r["detail_id"] for r in jobs.read_orders(spark, out, monthly=True).collect()) == [20, 50, 60]


def test_a_batch_reads_files_of_its_own_ids(spark, tmp_path):
    """What a lookup of the order sides opens grows with the ids asked for, not with what is stored."""
    sides = jobs.OrderSides(spark, f"{tmp_path}/sides", datetime.timedelta(days=1))
    sides.details.rows_per_file, sides.details.small_rows = 50, 0
    for batch in range(4):
        sides.details.write(make_details(spark, *[(1000 * batch + n, 100 * n + batch, text()) for n in range(200)]), batch, "q")
    sides.details.merge()
    [run_] = sides.details.manifest.current()["runs"]
    found = sides.details.lookup(spark.createDataFrame([(101,), (102,)], "id long"))
    assert len(run_["files"]) >= 8 and len(found.inputFiles()) <= 2
    assert sorted(r["id"] for r in found.collect()) == [1001, 2001]


def test_a_pair_is_written_once_and_like_runs_gather(spark, tmp_path):
    """An order and its line item of one batch are on record under each other's id, and still one pair; runs of like size
    are not rewritten with every batch."""
    out, topic = f"{tmp_path}/wide", {n: f"{tmp_path}/{n}" for n in ("orders", "details")}
    topics.land(write_records(make_orders(spark, (1, text()), (2, text()))).coalesce(1), topic["orders"])
    topics.land(write_records(make_details(spark, (10, 1, text()), (10, 2, text()), (11, 1, text()))).coalesce(1), topic["details"])
    streams = [topics.read_folder(spark, topic[n]) for n in ("orders", "details")]
    run(jobs.stored_order_job(*streams, f"{tmp_path}/sides", out, dims, datetime.date(2024, 6, 30)), tmp_path)
    pairs = [(r["order_id"], r["detail_id"]) for r in spark.read.parquet(out).collect()]
    assert sorted(pairs) == [(1, 10), (1, 11), (2, 10)]
    store = jobs.OrderSides(spark, f"{tmp_path}/sides", datetime.timedelta(1)).orders
    store.small_rows = 10
    alike = [{"rows": 100}] * 4
    assert store._alike(alike) == [] and len(store._alike([*alike, {"rows": 120}, {"rows": 1}, {"rows": 10 ** 6}])) == 6


def test_epochs_order_the_batches_of_two_checkpoints(spark, tmp_path):
    out = f"{tmp_path}/wide"
    schema = jobs.FACT

    def job(value):
        def write(batch, batch_id):
            tables.write_batch(batch.selectExpr("'k' AS topic", f"concat('{value}', value) AS value"), out, batch_id, "topic")
        return topics.read_folder(spark, f"{tmp_path}/{value}").writeStream.foreachBatch(write)

    for value, batches in (("old", 3), ("new", 1)):
        for _ in range(batches):
            topics.land(spark.createDataFrame([("v",)], "value string"), f"{tmp_path}/{value}")
            run(job(value), tmp_path, f"checkpoint-{value}")
    assert [tuple(r) for r in tables.read_latest(spark, out, schema, ["topic"]).collect()] == [("k", "newv")]


def test_partitions_by_cores(spark, tmp_path):
    """A stream with little state has a few partitions for each core, whatever the session's number, and no more than that."""
    name, topic = "spark.sql.shuffle.partitions", f"{tmp_path}/topic"
    topics.land(write_records(pages(spark, page("a", MIDNIGHT), page("a", MIDNIGHT + 1))), topic)
    before = spark.conf.get(name)
    for number, (of_session, expected) in enumerate((("40", 32), ("3", 3))):
        spark.conf.set(name, of_session)
        try:
            seen = jobs.bounded_dedup(topics.read_folder(spark, topic), "1 day").select("dt", "mid")
            writer = seen.writeStream.format("parquet").option("path", f"{tmp_path}/seen-{number}")
            query = finish(start(writer, f"{tmp_path}/checkpoint-{number}", available_now=True, by_cores=spark))
            assert spark.conf.get(name) == of_session
        finally:
            spark.conf.set(name, before)
        assert {s["numShufflePartitions"] for s in query.recentProgress[0]["stateOperators"]} == {expected}
        assert spark.read.schema("dt string, mid string").parquet(f"{tmp_path}/seen-{number}").count() == 1


def test_slices_of_a_large_batch_give_the_same_rows(spark, tmp_path, monkeypatch):
    """A batch joined and judged in many slices of the order ids gives what it gives in one, and leaves nothing behind."""
    import os

    order_rows = [[(n, text(h)) for n in range(h, 40, 2)] for h in (0, 1)]
    detail_rows = [[(100 + n, n + 3, text(n % 30)) for n in range(h, 40, 2)] for h in (1, 0)]
    found = []
    for most in (10 ** 9, 5):
        monkeypatch.setattr(jobs, "SLICE_ROWS", most)
        root = f"{tmp_path}/{most}"
        topic = {n: f"{root}/{n}" for n in ("orders", "details")}
        for last, (new_orders, new_details) in enumerate(zip(order_rows, detail_rows)):
            late = [(1000, text(90))] if last else []
            topics.land(write_records(make_orders(spark, *new_orders, *late)).coalesce(1), topic["orders"])
            topics.land(write_records(make_details(spark, *new_details)).coalesce(1), topic["details"])
            streams = [topics.read_folder(spark, topic[n]) for n in ("orders", "details")]
            run(jobs.stored_order_job(*streams, f"{root}/sides", f"{root}/wide", dims, datetime.date(2024, 6, 30),
                                      unmatched_to=jobs.folder_sink(f"{root}/lost")), root)
        pairs = spark.read.parquet(f"{root}/wide").drop("batch_id", "epoch")
        found.append([sorted(map(str, pairs.collect())), sorted(map(tuple, jobs.read_unmatched(spark, f"{root}/lost").collect()))])
        assert len(jobs.OrderSides(spark, f"{root}/sides", datetime.timedelta(1)).slices()) == (1 if most > 5 else 8)
        assert not [n for n in os.listdir(f"{root}/sides") if n.startswith("held-")]
    assert found[0] == found[1] and found[0][0] and found[0][1]


def test_shuffle_files_of_a_batch_end_with_it(spark, tmp_path, monkeypatch):
    """What an order batch shuffles is gone from disk when it is over, and nothing of it stays cached."""
    seen = []
    monkeypatch.setattr(jobs.OrderSides, "pairs", lambda self, *args, whole=jobs.OrderSides.pairs: seen.append(
        self.spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")) or whole(self, *args))
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false")
    topics.land(write_records(make_orders(spark, (1, text()))), f"{tmp_path}/orders")
    topics.land(write_records(make_details(spark, (10, 1, text()))), f"{tmp_path}/details")
    streams = [topics.read_folder(spark, f"{tmp_path}/{n}") for n in ("orders", "details")]
    held = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    run(jobs.stored_order_job(*streams, f"{tmp_path}/sides", f"{tmp_path}/wide", dims), tmp_path)
    assert seen == ["true"] and spark.sparkContext._jsc.sc().getPersistentRDDs().size() == held
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before


def test_orders_read_whole_shuffle_only_repeated_keys(spark, tmp_path):
    """Of keys that several rows have the newest version counts; null keys are keys. Without such keys nothing is shuffled."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("dt", "id", "v")])
    out = f"{tmp_path}/wide"

    def rows(*values):
        return spark.createDataFrame(list(values), schema)

    tables.write_batch(rows(("a", "1", "old"), ("a", "2", "only"), ("b", None, "old")), out, 0)
    once = tables.read_latest_settled(spark, out, schema, ["dt", "id"])
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString() and once.count() == 3
    tables.write_batch(rows(("a", "1", "new"), ("b", None, "new"), ("b", "1", "other"), ("b", "1", "other")), out, 1)
    want = [("a", "1", "new"), ("a", "2", "only"), ("b", "1", "other"), ("b", None, "new")]
    for read in (tables.read_latest_settled, tables.read_latest):
        assert sorted(map(tuple, read(spark, out, schema, ["dt", "id"]).collect()), key=str) == want


def test_a_large_batch_of_messages_is_not_shuffled(spark, tmp_path):
    """A batch in more splits than cores is written by the tasks that read it; one of few splits is gathered by topic."""
    cores = spark.sparkContext.defaultParallelism
    made = spark.range(0, 4000, 1, 3 * cores).select(F.concat(F.lit("T"), F.col("id") % 3).alias("topic"), F.col("id").cast("string").alias("value"))
    for name, rows in (("large", made), ("small", made.coalesce(cores))):
        jobs.folder_sink(f"{tmp_path}/{name}")(rows, 0)
        found = tables.read_versions(spark, f"{tmp_path}/{name}", jobs.FACT)
        assert sorted(map(tuple, found.select("topic", "value").collect())) == sorted(map(tuple, made.collect()))
        assert len(found.inputFiles()) == (9 * cores if name == "large" else 3)
