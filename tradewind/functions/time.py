"""Dates, hours and ages. All of them follow the session time zone."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F

DATETIME = "yyyy-MM-dd HH:mm:ss"


def event_date(ts_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ts_ms), "yyyy-MM-dd")


def event_hour(ts_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ts_ms), "HH")


def text_date(datetime_text: Column) -> Column:
    return F.split(datetime_text, " ")[0]


def text_hour(datetime_text: Column) -> Column:
    return F.split(F.get(F.split(datetime_text, " "), F.lit(1)), ":")[0]


def text_timestamp(datetime_text: Column) -> Column:
    return F.try_to_timestamp(datetime_text, F.lit(DATETIME))


def on_date(as_of: datetime.date | None) -> Column:
    """The day ages are counted to; the current one unless the job pins it."""
    return F.current_date() if as_of is None else F.lit(as_of)


def age_years(birthday: Column, as_of: Column) -> Column:
    """Whole calendar years: someone born on 29 February has their birthday on 1 March of a common year."""
    not_yet = F.date_format(as_of, "MMdd") < F.date_format(birthday, "MMdd")
    return (F.year(as_of) - F.year(birthday) - not_yet.cast("int")).cast("int")
