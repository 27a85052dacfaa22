"""Chat formatting by schema fingerprints, with DataFrame functions only.

A record is a struct whose fields depend on its layout. The paths of the nested fields that a record has, of those
that any mapping reads, are joined and hashed; the hash selects a declarative mapping, which turns the record into
turns of role and text. A mapping has a hash for each choice of its optional fields.
Turns are written as `<|im_start|>role\\ntext<|im_end|>\\n`. Inside roles and texts a backslash goes after every
`<` that a bar or backslash follows, so that no marker can occur in them, and the reading takes it away again.

Defined results: a null or missing text is empty, a null role too; a missing system text makes no turn; a record
whose fingerprint no mapping has gets a null layout, null turns and a null format, to be seen and not mistaken for an
empty one; equal turns stay; a record with an empty list of turns is formatted as the empty string; ids must tell
the records apart (a null id is one record); fields that no mapping reads do not matter; extra columns, whatever
their names but for schema_print, layout and turns, which are replaced, stay beside; long texts are single strings.
"""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """A layout: the field paths it has and those it may have, and where its turns are.

    Either `fields`, pairs of role and the paths whose texts make the turn (joined by a line break), or
    `messages`, an array's path with the names of its role and text fields and what its roles are called here. Of
    `fields`, the turns of the roles in `droppable` are left out where their texts are missing.
    """

    name: str
    paths: tuple[str, ...]
    optional: tuple[str, ...] = ()
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    droppable: tuple[str, ...] = ("system",)
    messages: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()


MAPPINGS = (
    Mapping("prompt", ("prompt",), ("response", "system"),
            (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("instruction", ("instruction",), ("input", "output", "system"),
            (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("messages", ("messages[].content", "messages[].role"), messages=("messages", "role", "content")),
    Mapping("conversations", ("conversations[].from", "conversations[].value"),
            messages=("conversations", "from", "value"), roles=(("human", "user"), ("gpt", "assistant"))),
)
# Every field that a mapping reads: the schema to parse JSON records with.
RECORD = ("prompt string, response string, system string, instruction string, input string, output string, "
          "messages array<struct<role:string,content:string>>, conversations array<struct<from:string,value:string>>")


def _paths(name: str, value: Column, kind: T.DataType) -> list[tuple[str, Column]]:
    """(path, is it there) of every leaf; the leaves of an array are there if the array is not null."""
    if isinstance(kind, T.StructType):
        return [(f"{name}.{path}" if name else path, value.isNotNull() & there) for field in kind
                for path, there in _paths(field.name, value.getField(field.name), field.dataType)]
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return [(f"{name}[].{field.name}", value.isNotNull()) for field in kind.elementType]
    return [(name, value.isNotNull())]


def fingerprint(record: Column, kind: T.StructType, read: set[str]) -> Column:
    """Hash of the sorted paths, of those read, of the fields that the record has."""
    found = sorted((x for x in _paths("", record, kind) if x[0] in read), key=lambda x: x[0])
    return F.xxhash64(F.concat_ws("\n", *[F.when(there, F.lit(path)) for path, there in found]))


def _literal_hashes(mapping: Mapping) -> list[Column]:
    """The mapping's fingerprint with each choice of its optional paths."""
    choices = itertools.chain.from_iterable(
        itertools.combinations(mapping.optional, n) for n in range(len(mapping.optional) + 1))
    return [F.xxhash64(F.lit("\n".join(sorted({*mapping.paths, *more})))) for more in choices]


def _get(record: Column, path: str) -> Column:
    for name in path.split("."):
        record = record.getField(name)
    return record


def _turns(mapping: Mapping, record: Column, there: set[str]) -> Column:
    if mapping.messages:
        path, role, text = mapping.messages
        names = F.create_map(*[F.lit(x) for pair in mapping.roles for x in pair]) if mapping.roles else None

        def turn(message: Column) -> Column:
            own = F.coalesce(message.getField(role), F.lit(""))
            if names is not None:
                own = F.coalesce(F.try_element_at(names, own), own)
            return F.struct(own.alias("role"), F.coalesce(message.getField(text), F.lit("")).alias("text"))

        return F.transform(_get(record, path), turn).cast(TURNS)
    turns = []
    for role, paths in mapping.fields:
        texts = [_get(record, path) for path in paths if path in there]
        turn = F.struct(F.lit(role).alias("role"), F.concat_ws("\n", *texts, F.lit(None).cast("string")).alias("text"))
        if role in mapping.droppable:
            turn = F.when(functools.reduce(operator.or_, [t.isNotNull() for t in texts]), turn) if texts else None
        if turn is not None:
            turns.append(turn)
    return F.array_compact(F.array(*turns)).cast(TURNS)


def _has(kind: T.StructType, mapping: Mapping) -> bool:
    return set(mapping.paths) <= set(_names("", kind))


def _names(name: str, kind: T.DataType) -> list[str]:
    if isinstance(kind, T.StructType):
        return [path for field in kind for path in _names(f"{name}.{field.name}" if name else field.name, field.dataType)]
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return [f"{name}[].{field.name}" for field in kind.elementType]
    return [name]


def canonical(records: DataFrame, record: str, mappings: Sequence[Mapping] = MAPPINGS) -> DataFrame:
    """records with layout (the mapping's name) and turns; mappings that the schema cannot hold are left out."""
    kind = records.schema[record].dataType
    there = set(_names("", kind))
    read = {path for mapping in mappings for path in (*mapping.paths, *mapping.optional)}
    value, print_ = F.col(f"`{record}`"), fingerprint(F.col(f"`{record}`"), kind, read)
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for mapping in mappings:
        if _has(kind, mapping):
            same = F.col("schema_print").isin(*_literal_hashes(mapping))
            layout = F.when(same, mapping.name).otherwise(layout)
            turns = F.when(same, _turns(mapping, value, there)).otherwise(turns)
    return records.withColumn("schema_print", print_).withColumn("layout", layout).withColumn("turns", turns)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<([\\|])", r"<\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\([\\|])", "<$1")


def _escape_role(role: Column) -> Column:
    # A line break ends the role, so it is written as a mark that no escaped text has.
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n"), F.lit("\n")))


def format_turns(records: DataFrame, id_col: str, turns: str = "turns", train_on: str = "assistant") -> DataFrame:
    """(id, formatted, loss_spans): the text of each record and where its loss counts, as start and length in
    characters of `formatted`, a span for every non-empty text of the role `train_on`, markers left out. Null turns
    have a null text."""
    head = F.concat(F.lit(START), _escape_role(F.coalesce(F.col("turn.role"), F.lit(""))), F.lit("\n"))
    rows = records.select(id_col, F.col(turns).isNull().alias("none"), F.posexplode_outer(turns).alias("place", "turn")).select(
        id_col, "none", "place", F.col("turn.role").alias("role"), head.alias("head"),
        escape(F.coalesce(F.col("turn.text"), F.lit(""))).alias("body"))
    rows = rows.withColumn("part", F.when(F.col("place").isNull(), "").otherwise(F.concat("head", "body", F.lit(f"{END}\n"))))
    before = Window.partitionBy(id_col).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("part")).over(before), F.lit(0)) + F.length("head")
    span = F.when((F.col("role") == train_on) & (F.length("body") > 0),
                  F.struct(start.cast("long").alias("start"), F.length("body").cast("long").alias("length")))
    parts = rows.select(id_col, "none", "place", "part", span.alias("span"))
    gathered = parts.groupBy(id_col).agg(F.bool_and("none").alias("none"), F.array_sort(F.collect_list(F.struct("place", "part", "span"))).alias("parts"))
    return gathered.select(
        id_col, F.when(~F.col("none"), F.array_join(F.col("parts.part"), "")).alias("formatted"),
        F.array_compact(F.col("parts.span")).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    ends = F.split(formatted, r"<\|im_end\|>\n")
    parts = F.slice(ends, F.lit(1), F.size(ends) - 1)

    def turn(part: Column) -> Column:
        role = F.substring_index(part.substr(F.lit(len(START) + 1), F.length(part)), "\n", 1)
        text = part.substr(F.length(role) + len(START) + 2, F.length(part))
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """The texts under the loss mask, in order."""
    return F.transform(spans, lambda span: unescape(
        formatted.substr((span.getField("start") + 1).cast("int"), span.getField("length").cast("int"))))
