"""JSON to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tradewind.schemas import as_text

_CORRUPT = "_corrupt_record"


def once(df: DataFrame, name: str, expression: Column, *keep: str) -> DataFrame:
    """`keep` columns and a costly expression that is worked out once per row, whatever reads it.

    A filter on a projected column is pushed below the projection with a copy of its expression for
    every use. It is not pushed below a generator, so a one-element explode keeps a JSON parse single.
    """
    computed = df.select(*keep, expression.alias(name))
    return computed.select(*keep, F.explode(F.array(name)).alias(name))


def typed_fields(parsed: str, schema: T.StructType) -> list[Column]:
    """Cast the string fields of struct column `parsed` to `schema`; what does not fit becomes null."""
    return [F.col(f"{parsed}.{f.name}").try_cast(f.dataType).alias(f.name) for f in schema.fields]


def read_records(messages: DataFrame, schema: T.StructType, value: str = "value", metric: str | None = None,
                 complete: Column | None = None, rejected: str | None = None) -> DataFrame:
    """Messages holding one flat JSON object each -> typed rows; other text gives no row.

    Under the name `metric`, a stream's progress reports the messages read and those that gave no row.
    With a column `rejected`, every message gives a row, and those that are unreadable or not `complete` (a
    condition on the typed columns) have their text there; the others have null.
    """
    text = T.StructType([*as_text(schema).fields, T.StructField(_CORRUPT, T.StringType())])
    record = F.from_json(value, text, {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = once(messages.select(value), "_record", record, *([value] if rejected else []))
    readable = F.col("_record").isNotNull() & F.col(f"_record.{_CORRUPT}").isNull()
    if metric:
        parsed = parsed.observe(metric, F.count(F.lit(1)).alias("messages"), F.count_if(~readable).alias("unreadable"))
    if rejected is None:
        return parsed.where(readable).select(*typed_fields("_record", schema))
    rows = parsed.select(*typed_fields("_record", schema), readable.alias("_readable"), F.col(value).alias("_text"))
    good = F.col("_readable") if complete is None else F.col("_readable") & F.coalesce(complete, F.lit(False))
    return rows.select(*schema.fieldNames(), F.when(~good, F.coalesce("_text", F.lit(""))).alias(rejected))


def write_records(records: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Typed rows -> one JSON object per row in `value`; nulls are left out of the text."""
    return records.select(F.to_json(F.struct(*(columns or records.columns))).alias("value"))
