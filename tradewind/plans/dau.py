"""Daily active users: the first entry page of a device on a day, with user and province."""

from __future__ import annotations

from collections.abc import Sequence
import datetime

from pyspark.sql import DataFrame, functions as F

from tradewind.functions.time import event_date, event_hour, on_date
from tradewind.operators.dimensions import with_province, with_user
from tradewind.operators.keyed import first_per_key
from tradewind.operators.records import project_by_name
from tradewind.schemas import DAU_INFO

KEY = ["dt", "mid"]


def entry_pages(page_logs: DataFrame) -> DataFrame:
    """Pages that open a visit: nothing was looked at before."""
    return page_logs.where(F.col("last_page_id").isNull())


def first_visits(page_logs: DataFrame) -> DataFrame:
    """One row per device and day of the event, the earliest; equal times fall to the other columns."""
    dated = entry_pages(page_logs).withColumn("dt", event_date(F.col("ts")))
    return first_per_key(dated, KEY, ["ts"])


def not_yet_seen(visits: DataFrame, seen: DataFrame) -> DataFrame:
    """First visits whose device is not yet on record for that day.

    The day's record is large and the batch's first visits are few, so the record is cut down to the
    batch's own keys by a semi-join before the anti-join; the record itself then needs no shuffle when
    the batch's keys can be broadcast.
    """
    known = seen.select(*KEY).join(visits.select(*KEY), KEY, "left_semi")
    return visits.join(known, KEY, "left_anti")


def enrich(visits: DataFrame, users: DataFrame, provinces: DataFrame, as_of: datetime.date | None = None,
           hot_users: Sequence = (), hot_provinces: Sequence = ()) -> DataFrame:
    """First visits -> the daily-active record, dimensions and hour filled in."""
    kept = visits.withColumn("hr", event_hour(F.col("ts")))
    wide = with_user(kept, users, on_date(as_of), "string", hot_users)
    wide = with_province(wide, provinces, "province_3166_2", hot_provinces)
    return project_by_name(wide, DAU_INFO)


def funnel_counts(page_logs: DataFrame) -> DataFrame:
    """Rows before the entry filter, after it, and after first-seen deduplication."""
    entry = F.col("last_page_id").isNull()
    visit = F.when(entry, F.struct(event_date(F.col("ts")).alias("dt"), "mid"))
    return page_logs.agg(F.count(F.lit(1)).alias("pages"), F.count_if(entry).alias("entry_pages"),
                         F.count_distinct(visit).alias("first_visits"))
