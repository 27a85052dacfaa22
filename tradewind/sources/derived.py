"""The commerce inputs, derived from the given tables by the formulas in FIXTURES.md.

Each input is a projection or an equi-join of whole tables; none of them gathers a group.
"""

from __future__ import annotations

from collections.abc import Sequence
import datetime
import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewind.functions.json import once
from tradewind.functions.time import DATETIME
from tradewind.sources.relational import read_parquet_table, spread_small

AS_OF = datetime.date(2024, 6, 30)


# Schemas of the given tables.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, sf_dir, name, TABLES[name])


def _text(column: Column) -> Column:
    return column.cast("string")


def _tagged(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), _text(number))


def _mod(column: str, by: int) -> Column:
    return F.col(column) % by


def _display(i: int) -> str:
    return (f"struct('promotion' AS display_type, string(k + {i}) AS item, 'sku_id' AS item_type, "
            f"'{i}' AS pos_id, '{i + 1}' AS `order`)")


def _action(i: int) -> str:
    return f"struct('act_{i}' AS action_id, string(k) AS item, 'sku_id' AS item_type, tsm + {i * 1000} AS ts)"


# The raw log line of FIXTURES.md F1, as a struct over (event_id, user_id, event_type, tsm, k, v100). The arrays are
# spelled out, as a lambda over a row's array is run without generated code.
_LINE = f"""struct(
    struct(string(user_id % 25) AS ar, string(user_id) AS uid, 'os_' || event_id % 2 AS os,
           'ch_' || event_id % 3 AS ch, string(event_id % 2) AS is_new, 'model_' || event_id % 7 AS md,
           'mid_' || user_id AS mid, 'v2.' || event_id % 4 AS vc, 'brand_' || event_id % 5 AS ba) AS common,
    tsm AS ts,
    CASE WHEN event_type = 'error' THEN struct(1000 + k AS error_code, 'e' AS msg) END AS err,
    CASE WHEN event_type = 'signup' THEN
        struct('entry_' || event_id % 3 AS entry, v100 AS loading_time, string(k) AS open_ad_id,
               k * 10 AS open_ad_ms, k * 3 AS open_ad_skip_ms) END AS start,
    CASE WHEN event_type <> 'signup' THEN
        struct(event_type AS page_id, string(k) AS item, 'sku_id' AS item_type, v100 AS during_time,
               CASE WHEN event_id % 3 <> 0 THEN 'home' END AS last_page_id,
               'src_' || event_id % 4 AS source_type) END AS page,
    CASE WHEN event_type <> 'signup' THEN
        slice(array({', '.join(map(_display, range(3)))}), 1, int(event_id % 4)) END AS displays,
    CASE WHEN event_type <> 'signup' THEN
        slice(array({', '.join(map(_action, range(2)))}), 1, int(event_id % 3)) END AS actions)"""


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON log line per event."""
    events = spread_small(table(spark, sf_dir, "events")).selectExpr(
        "event_id", "user_id", "event_type", "unix_millis(CAST(ts AS TIMESTAMP)) AS tsm",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k", "CAST(round(value * 100) AS BIGINT) AS v100")
    return once(events, "value", F.to_json(F.expr(_LINE)))


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
        "date_add(DATE '1955-01-01', int(c_custkey * 7919 % 18000)) AS birthday")


def base_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(
        "bigint(n_nationkey) AS id", "n_name AS name", "string(n_regionkey) AS region_id",
        "lpad(string(n_nationkey), 6, '0') AS area_code", "'CN-' || n_nationkey AS iso_code",
        "'CN-N' || n_nationkey AS iso_3166_2")


# An order is created at a second of its day that follows from its key.
_CREATED = "unix_seconds(timestamp(o_orderdate)) + o_orderkey * 7919 % 86400"


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_small(table(spark, sf_dir, "orders")).selectExpr(
        "o_orderkey AS id", "o_custkey % 25 AS province_id", "o_orderstatus AS order_status",
        "o_custkey AS user_id", "o_totalprice AS total_amount", "0D AS activity_reduce_amount",
        "0D AS coupon_reduce_amount", "o_totalprice AS original_total_amount", "0D AS feight_fee",
        "0D AS feight_fee_reduce", "string(NULL) AS expire_time", "string(NULL) AS refundable_time",
        f"date_format(timestamp_seconds({_CREATED}), '{DATETIME}') AS create_time",
        "string(NULL) AS operate_time")


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread_small(table(spark, sf_dir, "lineitem"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    created = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_CREATED} AS order_seconds")
    joined = (lines.join(parts, lines.l_partkey == parts.p_partkey)
              .join(created, lines.l_orderkey == created.o_orderkey))
    price = "CAST(l_extendedprice AS DECIMAL(18,2))"
    line_key = f"""concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, {price},
                   date_format(l_shipdate, 'yyyy-MM-dd'))"""
    return joined.selectExpr(
        f"bigint(conv(substr(md5({line_key}), 1, 15), 16, 10)) AS id", "l_orderkey AS order_id",
        "l_partkey AS sku_id", "p_retailprice AS order_price", "bigint(l_quantity) AS sku_num",
        "p_name AS sku_name",
        f"date_format(timestamp_seconds(order_seconds + l_partkey * 977 % 172800 - 43200), '{DATETIME}')"
        " AS create_time",
        "l_extendedprice AS split_total_amount",
        f"double({price} * CAST(l_discount AS DECIMAL(4,2))) AS split_activity_amount",
        "0D AS split_coupon_amount")


CHANGING = ("user_info", "base_province", "order_info", "order_detail")


def change_events(spark: SparkSession, sf_dir: str, tables: Sequence[str] = CHANGING) -> DataFrame:
    """Change stream messages of (value, offset) over the four tables, or those of them in `tables`; users with an
    earlier version."""
    users = spread_small(user_info(spark, sf_dir))
    other = F.when(F.col("gender") == "M", "F").otherwise("M")

    def events(name: str, rows: DataFrame, version: int = 1) -> DataFrame:
        turn = F.col("id") % 10
        kind = (F.when(turn == 0, "update").when(turn == 1, "delete").when(turn == 2, "bootstrap-insert")
                .when(turn == 3, "bootstrap-start").otherwise("insert"))
        event = F.struct(kind.alias("type"), F.lit(name).alias("table"), F.lit(version).alias("ts"),
                         F.struct(*rows.columns).alias("data"))
        return once(rows, "value", F.to_json(event)).withColumn("offset", F.lit(version).cast("bigint"))

    streams = {
        "user_info": lambda: events("user_info", users.withColumn("gender", other), 1).unionByName(
            events("user_info", users, 2)),
        "base_province": lambda: events("base_province", base_province(spark, sf_dir)),
        "order_info": lambda: events("order_info", order_info(spark, sf_dir)),
        "order_detail": lambda: events("order_detail", order_detail(spark, sf_dir))}
    return functools.reduce(DataFrame.unionByName, [streams[name]() for name in tables])


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per part. Its cast is its brand, its type and the words of its name, so that the
    array is bounded by the row itself."""
    cast = F.concat(F.array("p_brand", "p_type"), F.split("p_name", " "))
    return table(spark, sf_dir, "part").select(
        _text(F.col("p_partkey")).alias("id"), F.col("p_name").alias("name"),
        (F.col("p_size") / 5.0).alias("imdbScore"),
        F.transform(cast, lambda name: F.struct(name.alias("name"))).alias("actorList"))


def returned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returned, deeply discounted lines: the source of document changes."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.where((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09))


def doc_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new version of a part's document per returned line, and a first document per supplier."""
    lines = returned_lines(spark, sf_dir).select(
        _text(F.col("l_partkey")).alias("id"), F.concat(F.lit("returned to "), _text(F.col("l_suppkey"))).alias("name"),
        (F.col("l_quantity") / 5.0).alias("imdbScore"),
        F.array(F.struct(_tagged("supplier ", F.col("l_suppkey")).alias("name"))).alias("actorList"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("version"), F.col("l_orderkey").alias("minor"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), _text(F.col("s_suppkey"))).alias("id"), F.col("s_name").alias("name"),
        F.lit(1.0).alias("imdbScore"), F.array(F.struct(F.col("s_name").alias("name"))).alias("actorList"),
        F.lit("").alias("version"), F.lit(0).cast("bigint").alias("minor"))
    return lines.unionByName(suppliers)


def doc_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new score for every part with such a return; the name is left as it is."""
    best = returned_lines(spark, sf_dir).groupBy(_text(F.col("l_partkey")).alias("id")).agg(
        (F.max("l_quantity") / 5.0).alias("imdbScore"))
    return best.select("id", F.lit(None).cast("string").alias("name"), "imdbScore")


def returned_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returned_lines(spark, sf_dir).select(_text(F.col("l_partkey")).alias("id"))


def log_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.lit("ODS_BASE_LOG").alias("topic"), F.lit("ODS_BASE_LOG_GROUP").alias("group_id"),
        _mod("event_id", 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).cast("bigint").alias("offset"))


def categories(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    one = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    two = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("category1_id"))
    three = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("category2_id"))
    return one, two, three
