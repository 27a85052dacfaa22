"""Contiguous shards of near equal bytes, by global prefix sums.

Rows are range-partitioned by id and written once with their partition's number. The partitions' totals, a
row each, are summed up to offsets; a running sum inside each partition completes a row's place in the whole
corpus, in bytes and rows. The byte line is cut at equal targets, and a row belongs to the shard that holds its
middle byte. Only partition totals and shard starts, a few rows each, are ever in one task.

Defined results: a null text has no bytes and size 1; null ids come first; equal rows keep an arbitrary but
written order; a row larger than a target leaves shards empty; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import settle


def byte_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot): the UTF-8 bytes of each text plus one, its shard and place there."""
    spark = docs.sparkSession
    sized = docs.select(
        F.col(id_col).alias("id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = settle(sized.repartitionByRange(parts, "id", "text_crc32", "row").withColumn(
        "part", F.spark_partition_id()), "byte-shards")

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    offsets = totals.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.partitionBy()).alias("bytes_all"))

    inside = Window.partitionBy("part").orderBy("id", "text_crc32", "row")
    running = placed.withColumn("up_to", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("at", F.row_number().over(inside) - 1)
    # One row for each partition of the shuffle.
    lined = running.join(F.broadcast(offsets), "part").select(
        "id", "size", "text_crc32", (F.col("rows_before") + F.col("at")).alias("place"),
        F.least(F.lit(shards - 1), F.floor(
            (2 * (F.col("bytes_before") + F.col("up_to")) - F.col("size")) * F.lit(shards).cast("decimal(10,0)")
            / (2 * F.col("bytes_all")))).cast("int").alias("shard"))
    starts = lined.groupBy("shard").agg(F.min("place").alias("start"))
    # One row for each shard.
    return lined.join(F.broadcast(starts), "shard").select(
        "id", "size", "text_crc32", "shard", (F.col("place") - F.col("start")).alias("slot"))
