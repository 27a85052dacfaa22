"""Equi-joins that stay balanced when one key holds a large part of the rows.

Plain joins here carry no hint: Catalyst broadcasts a side only when its size is under
``spark.sql.autoBroadcastJoinThreshold``, and beyond that the adaptive planner splits oversized
sort-merge partitions. Where the adaptive split does not reach (a side that comes from an aggregate, a
full outer join, stream state), name the hot keys and the join spreads exactly those over `salts` tasks.
Which keys are named changes the plan only, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 64
ROW_SALT = "_salt"
PARTNER_SALT = "_partner_salt"


def add_row_salt(df: DataFrame, salts: int, when: Column | None = None) -> DataFrame:
    """A salt per row. Equal copies get different salts as they lie in different partitions."""
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *df.columns), F.lit(salts)).cast("int")
    return df.withColumn(ROW_SALT, spread if when is None else F.when(when, spread).otherwise(F.lit(0)))


def add_all_salts(df: DataFrame, salts: int, when: Column | None = None) -> DataFrame:
    """Every row once per salt, so that it meets its partners wherever they were sent."""
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    wanted = every if when is None else F.when(when, every).otherwise(F.array(F.lit(0)))
    return df.withColumn(PARTNER_SALT, F.explode(wanted))


def join_many_to_one(many: DataFrame, one: DataFrame, many_key: str, one_key: str, how: str = "inner",
                     on: Column | None = None, hot: Sequence = (), salts: int = SALTS) -> DataFrame:
    """Join rows to the side that has one row per key; `how` is inner, left, left_semi or left_anti.

    Column names of the two sides must not clash. `on` is an extra condition. `hot` lists keys of the
    many side to spread.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"the one side cannot be preserved: {how}")
    condition = F.col(many_key) == F.col(one_key)
    if on is not None:
        condition = condition & on
    if not hot:
        return many.join(one, condition, how)
    keys = list(hot)
    many = add_row_salt(many, salts, F.col(many_key).isin(keys))
    one = add_all_salts(one, salts, F.col(one_key).isin(keys))
    return many.join(one, condition & (F.col(ROW_SALT) == F.col(PARTNER_SALT)), how).drop(ROW_SALT, PARTNER_SALT)
