"""Database change events -> fact messages and the dimension table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind import names
from tradewind.functions.json import once
from tradewind.operators.keyed import latest_per_key
from tradewind.schemas import CDC_EVENT

# Which change types are of interest, and the letter each has in a topic name.
OPERATIONS = {"bootstrap-insert": "I", "insert": "I", "update": "U", "delete": "D"}

MAX_LISTED = 10_000


def operation(change_type: Column) -> Column:
    chain = F
    for name, letter in OPERATIONS.items():
        chain = chain.when(change_type == name, letter)
    return chain


def parse(messages: DataFrame, value: str = "value", offset: str | None = "offset") -> DataFrame:
    """table, type, op, ts, offset and the row image `data` as JSON text; op is null for other types."""
    position = (F.col(offset) if offset else F.lit(0)).cast("bigint").alias("offset")
    event = once(messages.select(F.col(value).alias("value"), position), "event",
                 F.from_json("value", CDC_EVENT), "value", "offset")
    return event.select(
        F.col("event.table").alias("table"), F.col("event.type").alias("type"),
        operation(F.col("event.type")).alias("op"), F.col("event.ts").try_cast("bigint").alias("ts"),
        "offset", F.col("event.data").alias("data"), "value")


def _readable() -> Column:
    return F.col("type").isNotNull() & F.col("table").isNotNull() & (F.col("op").isNull() | F.col("data").isNotNull())


def known(events: DataFrame) -> DataFrame:
    """Readable events of the types of interest."""
    return events.where(F.col("op").isNotNull() & _readable())


def dead_letters(events: DataFrame) -> DataFrame:
    """Messages that are no change event: unreadable, without type or table, or without a row image."""
    return events.where(~_readable()).select("value")


def _fact_topic(suffix: str) -> Column:
    return F.concat(F.lit("DWD_"), F.upper("table"), F.lit("_"), F.col("op"), F.lit(suffix))


def _fact_messages(events: DataFrame, suffix: str) -> DataFrame:
    return events.select(_fact_topic(suffix).alias("topic"), F.col("data").alias("value"))


def _dim_rows(events: DataFrame) -> DataFrame:
    row_id = F.get_json_object("data", "$.id")
    return events.select(
        F.upper("table").alias("table"), row_id.alias("id"),
        F.concat(F.lit("DIM:"), F.upper("table"), F.lit(":"), row_id).alias("dim_key"),
        "op", "ts", "offset", "data")


def fact_route(events: DataFrame, tables: Sequence[str] = names.FACT_TABLES,
               suffix: str = names.TOPIC_SUFFIX) -> DataFrame:
    """Row images of fact tables, each under the topic of its table and operation."""
    return _fact_messages(known(events).where(F.col("table").isin(*tables)), suffix)


def dim_route(events: DataFrame, tables: Sequence[str] = names.DIM_TABLES) -> DataFrame:
    """Row images of dimension tables. A table may be on both lists."""
    return _dim_rows(known(events).where(F.col("table").isin(*tables)))


def fact_messages(events: DataFrame, dead_topic: str, tables: Sequence[str] = names.FACT_TABLES,
                  suffix: str = names.TOPIC_SUFFIX) -> DataFrame:
    """``fact_route`` and the dead letters, under `dead_topic`, in one pass over the events."""
    dead = ~_readable()
    fact = ~dead & F.col("op").isNotNull() & F.col("table").isin(*tables)
    return events.where(dead | fact).select(
        F.when(dead, F.lit(dead_topic)).otherwise(_fact_topic(suffix)).alias("topic"),
        F.when(dead, F.col("value")).otherwise(F.col("data")).alias("value"))


def listed_names(control: DataFrame) -> tuple[list[str], list[str]]:
    """The tables that the control table names as facts and as dimensions."""
    return _names(control, "fact"), _names(control, "dim")


def _names(control: DataFrame, role: str) -> list[str]:
    """The tables that the control table names for a role.

    The names are read first, so that routing stays a filter: a join would send all events of one table
    to one task. A list longer than any database's number of tables is refused.
    """
    tables = control.where(F.col("role") == role).select(F.col("table_name").alias("table")).distinct()
    found = [r["table"] for r in tables.take(MAX_LISTED + 1)]
    if len(found) > MAX_LISTED:
        raise ValueError(f"the control table lists more than {MAX_LISTED} tables for {role}")
    return found


def listed(events: DataFrame, control: DataFrame, role: str) -> DataFrame:
    """Events of the tables that the control table names for a role."""
    return events.where(F.col("table").isin(_names(control, role)))


def dynamic_routes(events: DataFrame, control: DataFrame,
                   suffix: str = names.TOPIC_SUFFIX) -> tuple[DataFrame, DataFrame]:
    """As the two routes above, with the lists in a control table of (role, table_name)."""
    events = known(events)
    return _fact_messages(listed(events, control, "fact"), suffix), _dim_rows(listed(events, control, "dim"))


def dim_latest(dim_rows: DataFrame, drop_deleted: bool = False) -> DataFrame:
    """The last image of every dimension row: by change time, then by stream offset.

    A deleted row keeps its last image, so that late facts still find it, unless `drop_deleted`.
    """
    latest = latest_per_key(dim_rows, ["table", "id"], ["ts", "offset"])
    return latest.where(F.col("op") != "D") if drop_deleted else latest
