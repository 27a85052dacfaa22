"""Dimension lookups: left joins, so a row whose dimension is missing is kept with nulls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tradewind.functions.time import age_years
from tradewind.operators.skew import join_many_to_one


def with_user(df: DataFrame, users: DataFrame, as_of: Column, age_type: str, hot: Sequence = ()) -> DataFrame:
    """Add user_gender and user_age by user_id."""
    dim = users.select(
        F.col("id").cast(df.schema["user_id"].dataType).alias("_user"),
        F.col("gender").alias("user_gender"),
        age_years(F.col("birthday").try_cast("date"), as_of).cast(age_type).alias("user_age"))
    return join_many_to_one(df, dim, "user_id", "_user", "left", hot=hot).drop("_user")


def with_province(df: DataFrame, provinces: DataFrame, iso_3166_name: str, hot: Sequence = ()) -> DataFrame:
    """Add the province's name and codes by province_id."""
    dim = provinces.select(
        F.col("id").cast(df.schema["province_id"].dataType).alias("_province"),
        F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_code").alias("province_iso_code"),
        F.col("iso_3166_2").alias(iso_3166_name))
    return join_many_to_one(df, dim, "province_id", "_province", "left", hot=hot).drop("_province")
