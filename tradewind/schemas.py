"""Record schemas; nothing is ever inferred on a stream."""

from __future__ import annotations

from pyspark.sql import types as T


def record(text: str) -> T.StructType:
    """``"a b:long"`` -> struct<a: string, b: bigint>; a field without a type is a string."""
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "float": T.FloatType(),
             "timestamp": T.TimestampType(), "date": T.DateType(), "string": T.StringType()}
    fields = []
    for item in text.split():
        name, _, kind = item.partition(":")
        fields.append(T.StructField(name, kinds[kind or "string"]))
    return T.StructType(fields)


def as_text(schema: T.StructType) -> T.StructType:
    """The same field names, all strings: what a lenient JSON read asks for before casting."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


_VISIT = ("mid user_id province_id channel is_new model operate_system version_code brand "
          "page_id last_page_id page_item page_item_type during_time:long sourceType")

PAGE_LOG = record(f"{_VISIT} ts:long")
PAGE_DISPLAY_LOG = record(
    f"{_VISIT} display_type display_item display_item_type display_order display_pos_id ts:long")
PAGE_ACTION_LOG = record(f"{_VISIT} action_id action_item action_item_type action_ts:long ts:long")
START_LOG = record(
    "mid brand user_id province_id channel is_new model operate_system version_code entry open_ad_id "
    "loading_time_ms:long open_ad_ms:long open_ad_skip_ms:long ts:long")

DAU_INFO = record(
    "mid user_id province_id channel is_new model operate_system version_code page_id page_item "
    "page_item_type brand sourceType during_time:long user_gender user_age province_name "
    "province_iso_code province_3166_2 province_area_code dt hr ts:long")

ORDER_INFO_SOURCE = record(
    "id:long province_id:long order_status user_id:long total_amount:double "
    "activity_reduce_amount:double coupon_reduce_amount:double original_total_amount:double "
    "feight_fee:double feight_fee_reduce:double expire_time refundable_time create_time operate_time")
ORDER_INFO = T.StructType(ORDER_INFO_SOURCE.fields + record(
    "create_date create_hour province_name province_area_code province_3166_2_code province_iso_code "
    "user_age:int user_gender").fields)
ORDER_DETAIL = record(
    "id:long order_id:long sku_id:long order_price:double sku_num:long sku_name create_time "
    "split_total_amount:double split_activity_amount:double split_coupon_amount:double")
ORDER_WIDE = record(
    "detail_id:long order_id:long sku_id:long order_price:double sku_num:long sku_name "
    "split_total_amount:double split_activity_amount:double split_coupon_amount:double "
    "province_id:long order_status user_id:long total_amount:double activity_reduce_amount:double "
    "coupon_reduce_amount:double original_total_amount:double feight_fee:double "
    "feight_fee_reduce:double expire_time refundable_time create_time operate_time create_date "
    "create_hour province_name province_area_code province_3166_2_code province_iso_code "
    "user_age:int user_gender")

USER_INFO = record("id:long gender birthday:date")
BASE_PROVINCE = record("id:long name region_id area_code iso_code iso_3166_2")

# Raw log line. Leaves are strings, so that numbers, booleans and quoted numbers all survive the read;
# numeric fields are cast afterwards. `err` is opaque and kept as its JSON text.
RAW_LOG = T.StructType([
    T.StructField("common", record("ar uid os ch is_new md mid vc ba")),
    T.StructField("ts", T.StringType()),
    T.StructField("page", record("page_id item item_type during_time last_page_id source_type")),
    T.StructField("displays", T.ArrayType(record("display_type item item_type pos_id order"))),
    T.StructField("actions", T.ArrayType(record("action_id item item_type ts"))),
    T.StructField("start", record("entry loading_time open_ad_id open_ad_ms open_ad_skip_ms")),
    T.StructField("err", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])

# Change event. `data` has a different shape per table and is kept as its JSON text.
CDC_EVENT = record("type table ts data")

MESSAGE = record("topic key value")

# Documents of the search demo.
DOC = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("imdbScore", T.DoubleType()),
    T.StructField("actorList", T.ArrayType(record("name"))),
])

# Declared document mappings, applied by a cast before the write. Two fields of the daily-active record
# (brand, sourceType) are undeclared there and keep their own type.
DAU_MAPPING = record(
    "mid user_id province_id channel is_new model operate_system version_code page_id page_item "
    "page_item_type during_time:long user_gender user_age:int province_name province_iso_code "
    "province_3166_2 province_area_code dt hr ts:timestamp")
ORDER_MAPPING = record(
    "detail_id order_id sku_id sku_num:long sku_name order_price:float split_total_amount:float "
    "split_activity_amount:float split_coupon_amount:float province_id order_status user_id "
    "total_amount:float activity_reduce_amount:float coupon_reduce_amount:float "
    "original_total_amount:float feight_fee:float feight_fee_reduce:float expire_time:timestamp "
    "refundable_time:timestamp create_time:timestamp operate_time:timestamp create_date create_hour "
    "province_name province_area_code province_3166_2_code province_iso_code user_age:long user_gender")
