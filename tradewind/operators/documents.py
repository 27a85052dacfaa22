"""Document operations on a frame that has one row per id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.operators.keyed import latest_per_key


def bulk_upsert(target: DataFrame, updates: DataFrame, key: str = "id",
                version: Sequence[str] = ()) -> DataFrame:
    """Insert or replace whole documents by id; of several updates to one id the highest version wins.

    Updates shrink to one row per id before they meet the target. The target is only anti-joined, so
    with updates small enough to broadcast it is not shuffled at all.
    """
    newest = latest_per_key(updates, [key], version)
    newest = newest.select(*target.columns)
    kept = target.join(newest.select(key), key, "left_anti")
    return kept.unionByName(newest)


def append_generated_id(target: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Append every row under a generated id; running it twice appends twice."""
    fresh = new.withColumn(key, F.expr("uuid()"))
    return target.unionByName(fresh.select(*target.columns))


def update_by_id(target: DataFrame, patches: DataFrame, key: str = "id") -> DataFrame:
    """Replace the fields that a patch sets; fields it leaves null keep their value.

    `patches` has any subset of the other columns; of several patches to one id the largest counts.
    Unknown ids are ignored.
    """
    fields = [c for c in patches.columns if c != key]
    patch = latest_per_key(patches, [key], []).select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in fields])
    merged = target.join(patch, key, "left")
    return merged.select(*[
        F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in fields else F.col(c)
        for c in target.columns])


def delete_by_id(target: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return target.join(ids.select(key).distinct(), key, "left_anti")


def update_by_query(target: DataFrame, condition: Column, assign: Mapping[str, Column]) -> DataFrame:
    """Assign columns on the rows that meet the condition; the others stay as they are."""
    return target.select(*[
        F.when(condition, assign[c]).otherwise(F.col(c)).alias(c) if c in assign else F.col(c)
        for c in target.columns])


def get_by_id(target: DataFrame, value, key: str = "id") -> DataFrame:
    return target.where(F.col(key) == F.lit(value))


def search_field(target: DataFrame, field: str) -> DataFrame:
    """One field of every document."""
    return target.select(field)


def page_of(hits: DataFrame, sort: Sequence[Column], start: int, size: int) -> DataFrame:
    """`size` hits from position `start`. Each task keeps its own first start + size rows, no full sort."""
    return hits.orderBy(*sort).offset(start).limit(size)


def page_with_total(hits: DataFrame, sort: Sequence[Column], start: int, size: int,
                    total: str = "total_hits") -> DataFrame:
    """A page with the number of all hits beside it, in one pass over the hits.

    Each task sorts its own hits and hands on their number and the first start + size of them, as one row; these
    rows, one per task, are put together, sorted and cut.
    """
    ranged = hits.sortWithinPartitions(*sort).withColumns({
        "_task": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    first = F.when(F.col("_place") < start + size, F.struct(*hits.columns))
    tasks = ranged.groupBy("_task").agg(F.count(F.lit(1)).alias("_hits"), F.collect_list(first).alias("_first"))
    whole = tasks.agg(F.sum("_hits").alias(total), F.flatten(F.collect_list("_first")).alias("_first"))
    rows = whole.select(total, F.explode("_first").alias("_row")).select("_row.*", total)
    return page_of(rows, sort, start, size)


def terms_avg_topk(docs: DataFrame, term_array: Column, metric: str, size: int = 10) -> DataFrame:
    """Buckets of an array field's values by average metric, best first.

    `doc_count` counts documents, so a value repeated within one document counts once.
    """
    exploded = docs.select(F.explode(F.array_distinct(term_array)).alias("term"), F.col(metric))
    buckets = exploded.where(F.col("term").isNotNull()).groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_count"), F.round(F.avg(metric), 6).alias("avg_score"))
    return buckets.orderBy(F.desc("avg_score"), F.asc("term")).limit(size)
