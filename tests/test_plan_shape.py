"""What the plans must look like to hold at scale."""

import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from registry.queries import QUERIES
from tradewind.plans import orders
from tradewind.schemas import PAGE_LOG
from tradewind.session import scratch_root, tune
from tradewind.sources import derived, tables, topics
from tradewind.sources.relational import jdbc_options

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_python_no_cross_join_no_ungrouped_window(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    for word in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "Window ", "WindowGroup"):
        assert word not in plan, word


def test_log_lines_are_parsed_once(spark):
    for name in ("log_page", "log_split_counts", "dau_wide"):
        plan = physical(QUERIES[name](spark, SF))
        assert plan.count("from_json(") == 1, name


def test_routing_is_a_filter(spark):
    for name in ("cdc_fact_route", "cdc_dynamic_routing"):
        plan = physical(QUERIES[name](spark, SF))
        assert not re.search(r"Join \[table#", plan) and "Exchange hashpartitioning(table" not in plan


def test_first_visits_are_combined_before_the_shuffle(spark):
    plan = physical(QUERIES["dau_dedup"](spark, SF))
    assert re.search(r"SortAggregate.*final_min|SortAggregate.*functions=\[min", plan)
    after, before = plan.split("Exchange hashpartitioning(dt", 1)
    assert "SortAggregate" in after and "SortAggregate" in before


def test_scans_read_only_what_is_used(spark):
    plan = physical(QUERIES["order_amount_by_gender"](spark, SF))
    lineitem = next(s for s in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) if "l_orderkey" in s)
    assert "l_tax" not in lineitem and "l_linenumber" not in lineitem and "l_discount" not in lineitem
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_discount), EqualTo(l_returnflag,R)" in physical(
        QUERIES["delete_by_id"](spark, SF))


def test_large_sides_are_joined_by_shuffle_when_they_exceed_the_broadcast_limit(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("dau_wide", "order_wide"):
            plan = physical(QUERIES[name](spark, SF))
            assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.fixture
def tight(spark):
    """Small thresholds, so that the adaptive planner treats test data as it would treat large data."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _skewed(spark):
    """Line items of which two thirds belong to one order."""
    larger = SF.replace("0.001", "0.01")
    details = derived.order_detail(spark, larger)
    key = F.when(F.col("sku_num") % 3 != 0, 7).otherwise(F.col("order_id"))
    return derived.order_info(spark, larger), details.withColumn("order_id", key)


@pytest.mark.parametrize("function", [orders.order_wide, orders.detail_unmatched])
def test_a_hot_order_is_split_at_run_time(spark, tight, function):
    got = function(*_skewed(spark))
    got.collect()
    assert "skew=true" in physical(got)


def test_a_busy_day_is_written_by_several_tasks(spark, tight, tmp_path):
    rows = spark.range(0, 60000, 1, 8).selectExpr("md5(string(id)) AS mid", "IF(id % 10 = 0, '2024-01-02', '2024-01-01') AS dt")
    tables.write_batch(rows, str(tmp_path / "days"), 0)
    assert len(list((tmp_path / "days" / "dt=2024-01-01").glob("*.parquet"))) > 2


def test_scratch_is_shared_or_local(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda name, default=None: {"spark.master": "yarn"}.get(name, default))

    with pytest.raises(RuntimeError):
        scratch_root(Cluster)
    Cluster.conf.get = staticmethod(lambda name, default=None: {"spark.checkpoint.dir": "s3://x/"}.get(name, default))
    assert scratch_root(Cluster) == "s3://x"


def test_jdbc_reads_are_cut_into_ranges():
    options = jdbc_options("jdbc:mysql://h/db", "order_info", "id", 0, 1000, 64)
    assert (options["partitionColumn"], options["numPartitions"], options["upperBound"]) == ("id", "64", "1000")


def test_fact_fields_are_taken_in_one_pass_over_the_text(spark):
    plan = physical(QUERIES["cdc_fact_route"](spark, SF))
    assert "json_tuple" in plan and "get_json_object(value" not in plan


def test_splits_and_row_groups_of_messages_are_small(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
        assert int(tune(spark).conf.get("spark.sql.files.maxPartitionBytes")) == 16 << 20
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
        assert tune(spark).conf.get("spark.sql.files.maxPartitionBytes") == "4m"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    topic = tmp_path / "topic"
    topics.land(spark.range(0, 1_000_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).alias("value")), str(topic))
    (file,) = topic.glob("*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 2


def test_change_events_of_some_tables_read_no_others(spark, monkeypatch):
    some = derived.change_events(spark, SF, ("user_info", "base_province"))
    every = derived.change_events(spark, SF).where(F.get_json_object("value", "$.table").isin("user_info", "base_province"))
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.collect()))
    assert {name.rsplit("/", 1)[-1] for name in some.inputFiles()} == {"customer.parquet", "nation.parquet"}

    def unread(*_):
        raise AssertionError("line items are no dimension")

    monkeypatch.setattr(derived, "order_detail", unread)
    assert QUERIES["stream_dau_changing_dims"](spark, SF).count() > 0


def test_raw_lines_are_made_by_generated_code_only(spark):
    assert "lambda" not in physical(derived.raw_log(spark, SF))


def test_an_absent_table_costs_no_python_workers(spark, tmp_path):
    found = tables.read_versions(spark, f"{tmp_path}/nowhere", PAGE_LOG)
    assert found.columns == [*PAGE_LOG.fieldNames(), *tables.VERSION] and found.count() == 0
    assert "ExistingRDD" not in physical(found)
