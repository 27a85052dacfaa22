import datetime

import pytest
from pyspark.sql import functions as F

from tradewind.operators.keyed import latest_per_key
from tradewind.operators.skew import add_row_salt, join_many_to_one
from tradewind.plans import orders as plan
from tradewind.schemas import ORDER_DETAIL, ORDER_INFO_SOURCE, ORDER_WIDE
from tradewind.sources import derived

SF = "/root/testdata/sf0.001"
NOON = datetime.datetime(2024, 5, 1, 12)


def text(hours=0.0, seconds=0):
    return (NOON + datetime.timedelta(hours=hours, seconds=seconds)).strftime("%Y-%m-%d %H:%M:%S")


def make_orders(spark, *rows):
    full = [{"id": i, "user_id": 1, "province_id": 1, "create_time": at, "total_amount": 9.0} for i, at in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in ORDER_INFO_SOURCE.fieldNames()) for r in full],
                                 ORDER_INFO_SOURCE)


def make_details(spark, *rows):
    full = [{"id": i, "order_id": o, "create_time": at, "split_total_amount": 1.0} for i, o, at in rows]
    return spark.createDataFrame([tuple(r.get(n) for n in ORDER_DETAIL.fieldNames()) for r in full], ORDER_DETAIL)


def ids(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_retention_bounds_both_directions(spark):
    orders = make_orders(spark, (1, text()), (2, text()), (3, None))
    details = make_details(spark, (10, 1, text(24)), (11, 1, text(-24)), (12, 1, text(24, 1)), (13, 2, text(-24, -1)),
                           (14, 3, text()), (15, 99, text()))
    pairs = plan.order_wide(plan.with_create_parts(orders), details)
    assert ids(pairs, "detail_id", "order_id") == [(10, 1), (11, 1)]
    assert ids(plan.detail_unmatched(orders, details), "id") == [(12,), (13,), (14,), (15,)]
    assert ids(plan.order_unmatched(orders, details), "id") == [(2,), (3,)]


def test_wide_record_takes_the_details_time_and_the_orders_day(spark):
    orders = make_orders(spark, (1, text()))
    users = spark.createDataFrame([(1, "M", datetime.date(2000, 1, 1))], "id long, gender string, birthday date")
    provinces = spark.createDataFrame([], "id long, name string, area_code string, iso_code string, iso_3166_2 string")
    wide = plan.order_wide(plan.enrich(orders, users, provinces, datetime.date(2024, 6, 30)),
                           make_details(spark, (10, 1, text(13))))
    assert wide.schema.fieldNames() == ORDER_WIDE.fieldNames()
    [row] = wide.collect()
    assert (row["create_time"], row["create_date"], row["create_hour"]) == (text(13), "2024-05-01", "12")
    assert (row["user_age"], row["user_gender"], row["province_name"]) == (24, "M", None)


def test_a_replayed_order_pairs_once(spark):
    orders = make_orders(spark, (1, text()), (1, text()), (1, text(1)))
    pairs = plan.order_wide(latest_per_key(orders, ["id"], ["create_time"]), make_details(spark, (10, 1, text())))
    assert ids(pairs, "detail_id") == [(10,)]


@pytest.fixture(scope="module")
def whole(spark):
    frames = derived.order_info(spark, SF).cache(), derived.order_detail(spark, SF).cache()
    yield frames
    for frame in frames:
        frame.unpersist()


@pytest.mark.parametrize("function", [plan.order_wide, plan.full_outer, plan.order_unmatched, plan.detail_unmatched])
def test_naming_hot_keys_does_not_change_the_rows(spark, whole, function):
    orders, details = whole
    # Half of all line items belong to one order, and one named key has none.
    hot = details.select("order_id").first()[0]
    skewed = details.withColumn("order_id", F.when(F.col("split_total_amount") > 40000, hot).otherwise(F.col("order_id")))
    alone = orders.select("id").exceptAll(skewed.select(F.col("order_id").alias("id")).distinct()).first()[0]
    plain = function(orders, skewed)
    salted = function(orders, skewed, hot=[hot, alone], salts=5)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, salted.collect()))
    assert plain.count() > 0


def test_hot_left_join_keeps_rows_without_a_partner(spark):
    many = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    one = spark.createDataFrame([(1, "one")], "id int, name string")
    got = join_many_to_one(many, one, "k", "id", "left", hot=[1, 2], salts=3)
    assert sorted(map(tuple, got.select("v", "name").collect()), key=repr) == [
        ("a", "one"), ("a", "one"), ("b", None), ("c", None)]



def test_equal_copies_are_salted_apart(spark):
    copies = spark.range(0, 1000, 1, 8).select(F.lit(1).alias("k"))
    assert add_row_salt(copies, 4).select("_salt").distinct().count() > 1
