"""Ranked lexical search by branch and bound over frequency-ordered trees of documents.

Each document is restricted to the terms that the items have, as (term, times) in order of the terms' document
frequency, the most frequent first. A task takes such vectors a few thousand at a time and sorts them; those that
begin alike share a path, as in an FP-tree, and equal ones are one leaf, however many copies there are. Only branching
points are kept as nodes. A node has, over all documents below it, the largest number of times of each term and the
smallest m; the score grows with the one and falls with the other, so the score of these values bounds every document
below. The search goes down depth first and takes along the items whose bound reaches their twentieth best score
so far; at a leaf the bound is the score itself. A task hands on its best of each item, and these are merged in two
steps. Nothing is approximate: a document is left out only if an item has as many better ones.

Items are taken in blocks of bounded text, so that what a task holds of them is bounded; each block reads the
documents once. Document counts of a block's terms, and the number and length of documents, come to the driver.

Defined results: a null or empty text has no terms and is no document; an item without terms has no result; equal
scores go by ascending doc_id, null last; equal document rows are ranked each; equal rows of items are one item, and
two texts under one item id are ranked apart under that id; an empty table gives no rows; extra columns, whatever
their names, are not read; a long text is one vector of its different terms.
"""

from __future__ import annotations

import bisect
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradewind.llm.common import settle, small_batches, table_batches
from tradewind.llm.words import words_of

BEST = 20
# Bytes of item text in a block, documents of a tree, and tasks that merge one item's results first.
BLOCK_BYTES = 16 << 20
TREE_DOCUMENTS = 2048
MERGERS = 32
VECTOR, COUNTS = 0, 1


class Queries(NamedTuple):
    """Items by number: their different terms as ranks, each with weight times repeats, one item after another."""

    items: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    starts: np.ndarray

    def some(self, chosen: np.ndarray) -> Queries:
        sizes = np.diff(np.append(self.starts, len(self.terms)))
        entries = np.repeat(chosen, sizes)
        kept = sizes[chosen]
        return Queries(self.items[chosen], self.terms[entries], self.weights[entries], np.cumsum(kept) - kept)

    def scores(self, values: np.ndarray) -> np.ndarray:
        """The sum of weight times value over each item's terms; values by rank."""
        return np.add.reduceat(self.weights * values[self.terms], self.starts)


class Node(NamedTuple):
    """Terms as ranks with the most times of each below, the smallest m, and children; a leaf has document ids."""

    terms: np.ndarray
    times: np.ndarray
    m: int
    children: list
    ids: list


def _id_order(doc_id) -> tuple:
    return (doc_id is None, 0 if doc_id is None else doc_id)


def tree(ids: list, ms: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], best: int) -> Node | None:
    """The tree of some documents; vectors are (ranks ascending, times). Of equal documents a leaf keeps the `best`
    first ids, as no more can be in a result."""
    keys = [(terms.astype(">u4").tobytes(), times.tobytes(), m) for (terms, times), m in zip(vectors, ms, strict=True)]
    order = sorted(range(len(ids)), key=lambda n: (keys[n], _id_order(ids[n])))
    leaves, shared = [], []
    last = None
    for n in order:
        if last is not None and keys[n] == keys[last]:
            if len(leaves[-1].ids) < best:
                leaves[-1].ids.append(ids[n])
            continue
        terms, times = vectors[n]
        if last is not None:
            other = vectors[last][0]
            size = min(len(terms), len(other))
            differ = terms[:size] != other[:size]
            shared.append(int(differ.argmax()) if differ.any() else size)
        leaves.append(Node(terms, times, ms[n], [], [ids[n]]))
        last = n
    if not leaves:
        return None
    # Open nodes by the length of their path, the longest on top; a shorter common path closes the longer ones.
    open_paths: list[tuple[int, list]] = []
    for leaf, common in zip(leaves, [*shared, -1], strict=True):
        below = leaf
        while open_paths and open_paths[-1][0] > common:
            children = open_paths.pop()[1]
            children.append(below)
            below = _joined(children)
        if open_paths and open_paths[-1][0] == common:
            open_paths[-1][1].append(below)
        else:
            open_paths.append((common, [below]))
    return _joined(open_paths[0][1])


def _joined(children: list[Node]) -> Node:
    if len(children) == 1:
        return children[0]
    terms = np.concatenate([child.terms for child in children])
    order = np.argsort(terms, kind="stable")
    terms = terms[order]
    first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))
    times = np.maximum.reduceat(np.concatenate([child.times for child in children])[order], first)
    return Node(terms[first], times, min(child.m for child in children), children, [])


def search(root: Node, queries: Queries, values: np.ndarray, results: list[list], best: int) -> None:
    """Depth-first branch and bound: put the best documents of a tree into the results, by item (-score, id order).
    `values` is a scratch array of zeros, one for each rank."""
    least = np.array([-results[i][-1][0] if len(results[i]) == best else 1 for i in range(len(results))], dtype=np.int64)
    waiting = [(root, queries)]
    while waiting:
        node, live = waiting.pop()
        values[node.terms] = (1_000_000_000 * node.times) // (1000 * node.times + 12 * node.m)
        bounds = live.scores(values)
        values[node.terms] = 0
        chosen = bounds >= least[live.items]
        count = int(chosen.sum())
        if not count:
            continue
        if node.ids:
            for item, score in zip(live.items[chosen].tolist(), bounds[chosen].tolist(), strict=True):
                own = results[item]
                for doc_id in node.ids:
                    entry = (-score, _id_order(doc_id))
                    if len(own) == best and entry >= own[-1]:
                        break
                    bisect.insort(own, entry)
                    del own[best:]
                if len(own) == best:
                    least[item] = -own[-1][0]
            continue
        if 4 * count <= 3 * len(chosen):
            live = live.some(chosen)
        waiting.extend((child, live) for child in node.children)


def _vectors(docs: DataFrame, vocabulary, size: int, id_col: str, text_col: str) -> DataFrame:
    """Documents restricted to the vocabulary, and per task a row with each term's document count, the documents
    with any term, and all their terms."""
    id_type = docs.schema[id_col].dataType
    kind_of_id = to_arrow_type(id_type)
    names = ["kind", "doc_id", "n", "terms", "times"]

    def run(batches):
        known = pa.array(vocabulary.value, pa.large_binary())
        counts, totals = np.zeros(size, dtype=np.int64), np.zeros(2, dtype=np.int64)
        for batch in batches:
            words = words_of(batch.column(1))
            found = pc.fill_null(pc.index_in(words.array(), value_set=known), -1).to_numpy(zero_copy_only=False)
            held = found >= 0
            keys, times = np.unique(words.owners()[held] * np.int64(size) + found[held], return_counts=True)
            owner, terms = np.divmod(keys, size)
            counts += np.bincount(terms, minlength=size)
            totals += (np.count_nonzero(words.counts), words.counts.sum())
            rows = np.unique(owner)
            cuts = pa.py_buffer((4 * np.append(np.searchsorted(owner, rows), len(owner))).astype(np.int32))
            binary = [pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, cuts, pa.py_buffer(part.astype("<i4"))])
                      for part in (terms, times)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), VECTOR, dtype=np.int32)), batch.column(0).take(pa.array(rows)),
                 pa.array(words.counts[rows], pa.int64()), *binary], names)
        yield pa.RecordBatch.from_arrays(
            [pa.array([COUNTS], pa.int32()), pa.array([None], kind_of_id), pa.array([0], pa.int64()),
             pa.array([counts.tobytes()]), pa.array([totals.tobytes()])], names)

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, f"kind int, doc_id {id_type.simpleString()}, n long, terms binary, times binary")


def _totals(made: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """Document counts of the terms, documents, and all their terms: bounded by the vocabulary."""
    def run(batches):
        total = np.zeros(size + 2, dtype=np.int64)
        for batch in batches:
            for counts, totals in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total += np.concatenate([np.frombuffer(counts, dtype=np.int64), np.frombuffer(totals, dtype=np.int64)])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    summed = made.where(F.col("kind") == COUNTS).select("terms", "times").mapInArrow(run, "at long, n long").groupBy("at").agg(
        F.sum("n").alias("n")).toArrow()
    total = np.zeros(size + 2, dtype=np.int64)
    total[summed["at"].to_numpy()] = summed["n"].to_numpy()
    return total[:-2], int(total[-2]), int(total[-1])


def _item_terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(item, term, repeats) of each item's different terms, in order, and the terms."""
    words = words_of(pa.array(texts, pa.large_string()))
    coded = words.array().dictionary_encode()
    size = max(1, len(coded.dictionary))
    keys, repeats = np.unique(words.owners() * np.int64(size) + coded.indices.to_numpy(), return_counts=True)
    return keys // size, keys % size, repeats, coded.dictionary


def _best_of_block(docs: DataFrame, texts: list[str], best: int, id_col: str, text_col: str) -> DataFrame | None:
    """(item number, doc_id, score, part): the best documents of each task."""
    spark = docs.sparkSession
    item, term, repeats, vocabulary = _item_terms(texts)
    size = len(vocabulary)
    if not size:
        return None
    made = settle(_vectors(docs, spark.sparkContext.broadcast(vocabulary.to_pylist()), size, id_col, text_col), "lexical-vectors")
    frequency, documents, length = _totals(made, size)
    # Ranks by falling document frequency, ties by the term's number.
    order = np.argsort(-frequency, kind="stable")
    rank = np.empty(size, dtype=np.int64)
    rank[order] = np.arange(size)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist()], dtype=np.int64)
    starts = np.flatnonzero(np.append(True, item[1:] != item[:-1]))
    shared = spark.sparkContext.broadcast(
        (rank, Queries(item[starts], rank[term], weight[term] * repeats, starts)))
    id_type = made.schema["doc_id"].dataType
    kind_of_id = to_arrow_type(id_type)
    count = len(texts)

    def run(batches):
        rank, queries = shared.value
        values = np.zeros(size, dtype=np.int64)
        results: list[list] = [[] for _ in range(count)]
        for table in table_batches(batches, TREE_DOCUMENTS):
            vectors = []
            for terms, times in zip(table["terms"].to_pylist(), table["times"].to_pylist(), strict=True):
                ranks = rank[np.frombuffer(terms, dtype="<i4")]
                by_rank = np.argsort(ranks)
                vectors.append((ranks[by_rank], np.frombuffer(times, dtype="<i4")[by_rank].astype(np.int64)))
            ms = [100 - 25 + (25 * n * documents) // length for n in table["n"].to_pylist()]
            root = tree(table["doc_id"].to_pylist(), ms, vectors, best)
            if root is not None:
                search(root, queries, values, results, best)
        found = [(n, None if is_null else doc_id, -score) for n, own in enumerate(results) for score, (is_null, doc_id) in own]
        columns = zip(*found, strict=True) if found else ([], [], [])
        kinds = (pa.int32(), kind_of_id, pa.int64())
        part = TaskContext.get().partitionId() % MERGERS
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)), pa.array([part] * len(found), pa.int32())],
            ["number", "doc_id", "score", "part"])

    return made.where(F.col("kind") == VECTOR).select("doc_id", "n", "terms", "times").mapInArrow(
        run, f"number int, doc_id {id_type.simpleString()}, score long, part int")


def rank_documents(docs: DataFrame, items: DataFrame, best: int = BEST, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `best` highest-scoring documents, the highest first."""
    small_batches(docs.sparkSession)
    asked = settle(items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).where(
        F.col("text").isNotNull()).distinct(), "lexical-items")
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes)
    item_type = asked.schema["item_id"].dataType.simpleString()
    id_type = docs.schema[id_col].dataType.simpleString()
    empty = docs.sparkSession.createDataFrame([], f"item_id {item_type}, rank int, doc_id {id_type}, score long")
    ranked = []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        found = _best_of_block(docs, [r["text"] for r in rows], best, id_col, text_col) if rows else None
        if found is None:
            continue
        ids = docs.sparkSession.createDataFrame([(n, r["item_id"]) for n, r in enumerate(rows)], f"number int, item_id {item_type}")
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        for keys in (["number", "part"], ["number"]):
            place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            found = found.withColumn("rank", place).where(F.col("rank") <= best)
        ranked.append(found.join(F.broadcast(ids), "number").select("item_id", "rank", "doc_id", "score"))
    for more in ranked[1:]:
        ranked[0] = ranked[0].unionByName(more)
    return ranked[0] if ranked else empty
