"""Reports over the daily-active and order tables. Money is summed in decimal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.text import matches_any
from tradewind.operators.documents import page_with_total


def dau_by_day(dau: DataFrame) -> DataFrame:
    return dau.groupBy("dt").agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(dau: DataFrame) -> DataFrame:
    return dau.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("dau"))


def age_band(age: Column, width: int = 10) -> Column:
    """'20-29' and the like; 'unknown' when there is no age."""
    low = (F.floor(age / width) * width).cast("int")
    band = F.concat(low.cast("string"), F.lit("-"), (low + width - 1).cast("string"))
    return F.coalesce(band, F.lit("unknown"))


def order_amount_by(wide: DataFrame, key: Column, name: str) -> DataFrame:
    amount = F.sum(F.col("split_total_amount").cast("decimal(18,2)"))
    return wide.groupBy(key.alias(name)).agg(
        F.count(F.lit(1)).alias("details"), amount.cast("double").alias("amount"))


def order_item_search(wide: DataFrame, query: str, start: int, size: int,
                      columns: Sequence[str] = ("detail_id", "order_id", "sku_name", "split_total_amount")) -> DataFrame:
    """Items whose name holds a term of the query, dearest first, with the number of all such items."""
    hits = wide.where(matches_any(F.col("sku_name"), query)).select(*columns)
    return page_with_total(hits, [F.desc("split_total_amount"), F.asc("detail_id")], start, size)


def category_view(level1: DataFrame, level2: DataFrame, level3: DataFrame) -> DataFrame:
    """Three category levels, (id, name) and the parent's id, flattened to one row per third level."""
    one = level1.select(F.col("id").alias("category1_id"), F.col("name").alias("category1_name"))
    two = level2.select(F.col("id").alias("category2_id"), F.col("name").alias("category2_name"), "category1_id")
    three = level3.select("id", F.col("id").alias("category3_id"), F.col("name").alias("category3_name"),
                          "category2_id")
    return three.join(two, "category2_id").join(one, "category1_id").select(
        "id", "category1_id", "category1_name", "category2_id", "category2_name", "category3_id", "category3_name")
