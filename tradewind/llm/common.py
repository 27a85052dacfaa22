"""Helpers shared by the operators: written tables, batches, label samples."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import new_folder

# Rows that one Arrow batch carries into Python: a few MB of ordinary texts, and bounded with long ones.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends there, and it survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds of the texts it reads: by rows, and by bytes where texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def text_key(column: str) -> Column:
    """The MD5 of a text, 16 bytes: tells texts apart at any size of corpus. A null text is as an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col(f"`{column}`"), F.lit("")).cast("binary")))


def doc_key(doc_id: str) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Every fifth document by the CRC-32 of its id; a null id counts as held out."""
    return doc_key(doc_id) == 0


def bounded_sample(df: DataFrame, label: str, key: str, bound: int, salt: str) -> DataFrame:
    """About `bound` rows of each label (all of a smaller one), chosen by a hash of the key, not by place.

    The labels' counts are the only thing that reaches the driver.
    """
    scale = 1_000_000
    share = F.pmod(F.xxhash64(F.lit(salt), F.col(key)), F.lit(scale))
    chosen = F.lit(False)
    for row in df.groupBy(label).count().collect():
        if row[0] is not None:
            limit = min(scale, -(-bound * scale // row["count"]))
            chosen = chosen | ((F.col(label) == row[0]) & (share < limit))
    return df.where(chosen)


def table_batches(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Gather small batches until they have `rows` rows."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= rows:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if held:
        yield pa.Table.from_batches(held)


def byte_batches(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Gather small batches until they have `size` bytes."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.nbytes
        if count >= size:
            yield pa.Table.from_batches(held)
            held, count = [], 0
    if held:
        yield pa.Table.from_batches(held)
