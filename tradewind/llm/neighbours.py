"""Exact nearest neighbours by inner product: a block matrix join with int8 tiles.

Vectors are packed into blocks with int8 codes, a scale each, and the norms of what the codes leave out. Query
and candidate blocks are dealt over a grid of tasks, a stated query set against all rows. In a task the int8
product of a tile gives every inner product up to a bound from those norms; only pairs whose upper bound reaches
the query's k-th best are computed again, in double precision, and merged into the query's k best. The grid's
partial results, k rows a query and column of the grid, are merged by rank.

Of equal vectors in one block only the rows of the k + 1 smallest different ids are kept: no query can need more
of them, as only one of these ids can be its own.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor does a
null id; vectors of another length never meet; all rows with the query's id count as its own; a neighbour is a row,
so an id given n times can be n neighbours; an id with several query rows is one query, and a neighbour's score is its
best with any of their vectors; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import settle, table_batches

BLOCK = 2048
QUERIES_AT_ONCE = 8192
CANDIDATES_AT_ONCE = 1 << 20
PAIRS_AT_ONCE = 1 << 16
# int8 products summed in float32 stay exact up to this many components.
EXACT_COMPONENTS = 1024
# Rounding of the bounds themselves.
MARGIN = 1e-6
BLOCK_SCHEMA = "dim int, ids binary, vectors binary, codes binary, scale binary, size binary, slack binary"
BLOCK_NAMES = [part.split()[0] for part in BLOCK_SCHEMA.split(", ")]


def _vectors(table: pa.Table):
    """(ids, matrix) for each length of vector, of the rows that take part."""
    lists = table.column(1).combine_chunks()
    ids = table.column(0).combine_chunks()
    lengths = np.asarray(lists.value_lengths().fill_null(0))
    for dim in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero((lengths == dim) & np.asarray(ids.is_valid()))
        values = lists.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan)
        matrix = np.asarray(values).reshape(-1, dim)
        use = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        if use.any():
            yield np.asarray(ids.take(pa.array(rows[use]))).astype(np.int64), matrix[use]


def _first_of_equal(ids: np.ndarray, matrix: np.ndarray, most: int) -> np.ndarray:
    """Places that keep the `most` smallest different ids of each distinct vector, of each at most so many rows."""
    order = np.argsort(ids, kind="stable")
    # The number of different ids, the last of them, and its rows.
    seen: dict[bytes, tuple[int, int, int]] = {}
    keep = []
    for place, own in zip(order.tolist(), ids[order].tolist(), strict=True):
        row = matrix[place].tobytes()
        different, last, count = seen.get(row, (0, None, 0))
        if own == last and count < most:
            seen[row] = different, own, count + 1
        elif own != last and different < most:
            seen[row] = different + 1, own, 1
        else:
            continue
        keep.append(place)
    return np.array(keep, dtype=np.int64)


def _packer(most: int | None):
    def run(batches):
        for table in table_batches(batches, BLOCK):
            for ids, matrix in _vectors(table):
                if most is not None:
                    keep = _first_of_equal(ids, matrix, most)
                    ids, matrix = ids[keep], matrix[keep]
                for at in range(0, len(ids), BLOCK):
                    own = matrix[at:at + BLOCK]
                    scale = np.abs(own).max(axis=1) / 127
                    # A scale too small to divide by leaves the whole vector to the slack.
                    usable = scale > 1e-300
                    codes = np.rint(own / np.where(usable, scale, 1)[:, None]).astype(np.int8)
                    back = codes * scale[:, None]
                    parts = [own, codes, scale, np.linalg.norm(own, axis=1), np.linalg.norm(own - back, axis=1)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([own.shape[1]], pa.int32()), pa.array([ids[at:at + BLOCK].tobytes()], pa.binary()),
                         *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts]], BLOCK_NAMES)

    return run


class _Block:
    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"]).reshape(len(self.ids), -1)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(self.vectors.shape).astype(np.float32)
        self.rows = row["block"] * BLOCK + np.arange(len(self.ids))
        self.scale, self.size, self.slack = (np.frombuffer(row[name]) for name in ("scale", "size", "slack"))


class _Queries:
    """Query blocks of one length with the k best of each query so far."""

    def __init__(self, block: _Block, k: int):
        self.block, self.k = block, k
        self.scores = np.full((len(block.ids), k), -np.inf)
        self.found = np.full((len(block.ids), k), -1, dtype=np.int64)
        self.places = np.full((len(block.ids), k), -1, dtype=np.int64)

    def meet(self, other: _Block) -> None:
        mine = self.block
        product = np.zeros((len(mine.ids), len(other.ids)), dtype=np.float64)
        for at in range(0, mine.codes.shape[1], EXACT_COMPONENTS):
            part = slice(at, at + EXACT_COMPONENTS)
            product += mine.codes[:, part] @ other.codes[:, part].T
        product *= mine.scale[:, None]
        product *= other.scale[None, :]
        # q.c - q'.c' = q.(c - c') + (q - q').c', and the norm of c' is at most that of c and of what it leaves out.
        bound = mine.size[:, None] * other.slack[None, :] + mine.slack[:, None] * (other.size + other.slack)[None, :]
        bound += MARGIN * (mine.size[:, None] * other.size[None, :]) + 1e-300
        own = mine.ids[:, None] == other.ids[None, :]
        least = self.scores[:, -1]
        if product.shape[1] > self.k and np.isneginf(least).any():
            lower = product - bound
            lower[own] = -np.inf
            least = np.maximum(least, np.partition(lower, -self.k, axis=1)[:, -self.k])
        product += bound
        product[own] = -np.inf
        query, place = np.nonzero((product >= least[:, None]) & ~own)
        for at in range(0, len(query), PAIRS_AT_ONCE):
            q, c = query[at:at + PAIRS_AT_ONCE], place[at:at + PAIRS_AT_ONCE]
            exact = (mine.vectors[q] * other.vectors[c]).sum(axis=1)
            self._merge(q, exact, other.ids[c], other.rows[c])

    def _merge(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Keep the k best of the queries concerned, old and new."""
        touched = np.unique(query)
        owner = np.concatenate([np.repeat(touched, self.k), query])
        scores = np.concatenate([self.scores[touched].ravel(), score])
        found = np.concatenate([self.found[touched].ravel(), ids])
        places = np.concatenate([self.places[touched].ravel(), rows])
        order = np.lexsort((places, found, -scores, owner))
        owner, scores, found, places = owner[order], scores[order], found[order], places[order]
        first = np.searchsorted(owner, touched)
        rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
        keep = rank < self.k
        self.scores[owner[keep], rank[keep]] = scores[keep]
        self.found[owner[keep], rank[keep]] = found[keep]
        self.places[owner[keep], rank[keep]] = places[keep]

    def rows(self) -> list[np.ndarray]:
        use = ~np.isneginf(self.scores)
        owner = np.repeat(self.block.ids, self.k).reshape(self.scores.shape)
        return [owner[use], self.found[use], self.places[use], self.scores[use]]


def _searcher(k: int):
    """mapInArrow function over rows of grid cells, in each the query blocks before the candidate blocks."""
    def run(batches):
        cell, queries = None, {}

        def flush():
            for own in queries.values():
                for each in own:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in each.rows()], ["query_id", "vec_id", "place", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if (row["r"], row["s"]) != cell:
                    yield from flush()
                    cell, queries = (row["r"], row["s"]), {}
                block = _Block(row)
                if row["kind"] == 0:
                    queries.setdefault(row["dim"], []).append(_Queries(block, k))
                else:
                    for each in queries.get(row["dim"], []):
                        each.meet(block)
        yield from flush()

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of `vectors` nearest to each query, nearest first."""
    spark = vectors.sparkSession
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting, None)
    try:
        partial = _found(spark, vectors, queries, k, id_col, vector_col, setting)
    finally:
        # Both steps are written by now; what other operators build later keeps the session's own setting.
        spark.conf.set(setting, before) if before is not None else spark.conf.unset(setting)
    # The rows of one query id may have found the same neighbour.
    partial = partial.groupBy("query_id", "vec_id", "place").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def _found(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str,
           setting: str) -> DataFrame:
    """(query_id, vec_id, place, score): the best of each tile of query blocks and candidate blocks."""
    spark.conf.set(setting, "4096")

    def packed(df: DataFrame, most: int | None, label: str) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
        blocks = rows.mapInArrow(_packer(most), BLOCK_SCHEMA)
        return settle(blocks.withColumn("block", F.monotonically_increasing_id()), label)

    asked = packed(queries, None, "neighbour-queries")
    given = packed(vectors, k + 1, "neighbour-blocks")
    size = F.coalesce(F.sum(F.octet_length("ids")), F.lit(0)) / 8
    n_queries, n_given = asked.agg(size).first()[0], given.agg(size).first()[0]
    down = max(1, int(-(-n_queries // QUERIES_AT_ONCE)))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    across = max(1, int(-(-n_given // CANDIDATES_AT_ONCE)), min(int(-(-n_given // (4 * BLOCK))), -(-tasks // down)))

    def cells(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    grid = asked.select(F.pmod(F.xxhash64("block"), F.lit(down)).cast("int").alias("r"), cells(across).alias("s"),
                        F.lit(0).alias("kind"), "block", *BLOCK_NAMES).unionByName(
        given.select(cells(down).alias("r"), F.pmod(F.xxhash64("block"), F.lit(across)).cast("int").alias("s"),
                     F.lit(1).alias("kind"), "block", *BLOCK_NAMES))
    # A row is a whole block here: few of them to an Arrow batch.
    spark.conf.set(setting, "8")
    return settle(grid.repartition(down * across, "r", "s").sortWithinPartitions("r", "s", "kind").mapInArrow(
        _searcher(k), "query_id long, vec_id long, place long, score double"), "neighbour-partial")
