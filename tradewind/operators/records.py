"""Record shaping: projection by name and casts to a declared mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tradewind.functions.time import DATETIME


def project_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """Copy the fields that `target` has under the same name and type; its other fields are null."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[
        F.col(f.name) if have.get(f.name) == f.dataType else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.fields])


def cast_to_mapping(df: DataFrame, mapping: T.StructType) -> DataFrame:
    """Cast declared fields to their declared type; undeclared ones pass through as they are.

    A date field is read from epoch milliseconds when it holds a number, from date-time text otherwise.
    """
    declared = {f.name: f.dataType for f in mapping.fields}

    def mapped(field: T.StructField):
        want = declared.get(field.name, field.dataType)
        if field.dataType == want:
            return F.col(field.name)
        if isinstance(want, T.TimestampType):
            if isinstance(field.dataType, T.LongType):
                return F.timestamp_millis(field.name).alias(field.name)
            return F.try_to_timestamp(F.col(field.name), F.lit(DATETIME)).alias(field.name)
        return F.col(field.name).try_cast(want).alias(field.name)

    return df.select(*[mapped(f) for f in df.schema.fields])
