"""One row per key.

Both directions are an aggregate over a struct whose leading fields decide the winner. The aggregate
combines map-side, so a key that holds a third of all rows reaches its reducer as one row per task.
A window with ``row_number`` would bring the whole group to one task instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], choose) -> DataFrame:
    ordered = [*order, *[c for c in df.columns if c not in keys and c not in order]]
    if not ordered:
        return df.distinct()
    picked = df.groupBy(*keys).agg(choose(F.struct(*ordered)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the smallest `order` columns; ties fall to the smallest remaining columns."""
    return _pick(df, keys, order, F.min)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest `order` columns; ties fall to the largest remaining columns."""
    return _pick(df, keys, order, F.max)
