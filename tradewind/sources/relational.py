"""Relational tables: Parquet exports, or JDBC where a driver is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A table of the export; with its schema given no file is opened before the query runs."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def spread_small(df: DataFrame) -> DataFrame:
    """Use the cores for costly row work on a table that is read in a handful of splits.

    A large table has many splits and passes through without a shuffle.
    """
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, 32)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def jdbc_options(url: str, table: str, split_column: str, lower: int, upper: int,
                 partitions: int, fetch_rows: int = 10_000) -> dict[str, str]:
    """Options of a JDBC read cut into ranges of a numeric key, so that no one task reads a whole table."""
    return {"url": url, "dbtable": table, "partitionColumn": split_column, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions), "fetchsize": str(fetch_rows)}


def read_jdbc_table(spark: SparkSession, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
