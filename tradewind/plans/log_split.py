"""Raw behaviour log -> page, display, action, start and error records.

A record with `err` goes out whole and nowhere else. Any other record gives a page row, one row per
display and per action of that page, and a start row, each if present. What cannot be read goes to the
dead letters, where the batch would otherwise fail.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tradewind import names
from tradewind.functions.json import once
from tradewind.schemas import PAGE_ACTION_LOG, PAGE_DISPLAY_LOG, PAGE_LOG, RAW_LOG, START_LOG

# Where each output field is found in the raw record, relative to the part named.
COMMON = {"mid": "mid", "user_id": "uid", "province_id": "ar", "channel": "ch", "is_new": "is_new",
          "model": "md", "operate_system": "os", "version_code": "vc", "brand": "ba"}
PAGE = {"page_id": "page_id", "last_page_id": "last_page_id", "page_item": "item",
        "page_item_type": "item_type", "during_time": "during_time", "sourceType": "source_type"}
DISPLAY = {"display_type": "display_type", "display_item": "item", "display_item_type": "item_type",
           "display_order": "order", "display_pos_id": "pos_id"}
ACTION = {"action_id": "action_id", "action_item": "item", "action_item_type": "item_type",
          "action_ts": "ts"}
START = {"entry": "entry", "open_ad_id": "open_ad_id", "loading_time_ms": "loading_time",
         "open_ad_ms": "open_ad_ms", "open_ad_skip_ms": "open_ad_skip_ms"}


_READABLE = "coalesce(ltrim(value) LIKE '{%', false) AND rec IS NOT NULL AND rec._corrupt_record IS NULL"
_COMPLETE = "rec.common IS NOT NULL AND try_cast(rec.ts AS BIGINT) IS NOT NULL"
_ROUTE = f"""CASE WHEN NOT ({_READABLE}) THEN 'dead' WHEN rec.err IS NOT NULL THEN 'error'
             WHEN {_COMPLETE} THEN 'split' ELSE 'dead' END"""


# The parts of a record beside its common fields, time and error.
PARTS = ("page", "displays", "actions", "start")


def parse(lines: DataFrame, value: str = "value", parts: Sequence[str] = PARTS) -> DataFrame:
    """Each line with its record and the route it takes: error, split or dead.

    A caller that needs only some `parts` names them: the others are skipped by the JSON parser, neither made into
    columns nor checked, so a line whose only fault lies in a skipped part is not dead.
    """
    schema = T.StructType([f for f in RAW_LOG.fields if f.name not in PARTS or f.name in parts])
    rec = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = once(lines.select(F.col(value).alias("value")), "rec", rec, "value")
    return parsed.selectExpr("value", "rec", f"{_ROUTE} AS route")


def _fields(schema: T.StructType, *parts: tuple[Mapping[str, str], str]) -> list[str]:
    """Output columns in the schema's order; `parts` are field maps with the struct they read from."""
    found = {"ts": "rec.ts"}
    for mapping, part in parts:
        found.update({out: f"{part}.`{source}`" for out, source in mapping.items()})
    return [f"try_cast({found[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields]


_ON_PAGE = (COMMON, "rec.common"), (PAGE, "rec.page")
_PAGE_FIELDS = _fields(PAGE_LOG, *_ON_PAGE)
_DISPLAY_FIELDS = _fields(PAGE_DISPLAY_LOG, *_ON_PAGE, (DISPLAY, "display"))
_ACTION_FIELDS = _fields(PAGE_ACTION_LOG, *_ON_PAGE, (ACTION, "action"))
_START_FIELDS = _fields(START_LOG, (COMMON, "rec.common"), (START, "rec.start"))

_HAS_PAGE = "route = 'split' AND rec.page IS NOT NULL"
_HAS_START = "route = 'split' AND rec.start IS NOT NULL"


def error_log(parsed: DataFrame) -> DataFrame:
    return parsed.where("route = 'error'").select("value")


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where("route = 'dead'").select("value")


def page_log(parsed: DataFrame) -> DataFrame:
    return parsed.where(_HAS_PAGE).selectExpr(*_PAGE_FIELDS)


def display_log(parsed: DataFrame) -> DataFrame:
    shown = parsed.where(_HAS_PAGE).selectExpr("rec", "explode(rec.displays) AS display")
    return shown.where("display IS NOT NULL").selectExpr(*_DISPLAY_FIELDS)


def action_log(parsed: DataFrame) -> DataFrame:
    done = parsed.where(_HAS_PAGE).selectExpr("rec", "explode(rec.actions) AS action")
    return done.where("action IS NOT NULL").selectExpr(*_ACTION_FIELDS)


def start_log(parsed: DataFrame) -> DataFrame:
    return parsed.where(_HAS_START).selectExpr(*_START_FIELDS)


def split_messages(parsed: DataFrame, suffix: str = names.TOPIC_SUFFIX) -> DataFrame:
    """All outputs in one pass over the log: rows of (topic, value), each log line parsed once."""

    def message(base: str, value: str) -> str:
        return f"struct('{names.topic(base, suffix)}' AS topic, {value} AS value)"

    def json(fields: list[str]) -> str:
        return f"to_json(struct({', '.join(fields)}))"

    def one(condition: str, base: str, value: str) -> str:
        return f"CASE WHEN {condition} THEN array({message(base, value)}) ELSE array() END"

    def each(items: str, item: str, base: str, fields: list[str]) -> str:
        present = f"filter({items}, i -> i IS NOT NULL)"
        return (f"CASE WHEN {_HAS_PAGE} AND {items} IS NOT NULL "
                f"THEN transform({present}, {item} -> {message(base, json(fields))}) ELSE array() END")

    outputs = [
        one(_HAS_PAGE, names.PAGE_TOPIC, json(_PAGE_FIELDS)),
        each("rec.displays", "display", names.DISPLAY_TOPIC, _DISPLAY_FIELDS),
        each("rec.actions", "action", names.ACTION_TOPIC, _ACTION_FIELDS),
        one(_HAS_START, names.START_TOPIC, json(_START_FIELDS)),
        one("route = 'error'", names.ERROR_TOPIC, "value"),
        one("route = 'dead'", names.DEAD_LETTER_TOPIC, "value")]
    return parsed.selectExpr(f"inline(concat({', '.join(outputs)}))")
