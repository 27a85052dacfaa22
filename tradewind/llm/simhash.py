"""SimHash near-duplicate groups, with candidates found by pigeonring chains.

A fingerprint's 64 bits stand in a ring of 8 segments. If two fingerprints differ in at most 4 bits, then
from some segment on every chain of l consecutive segments differs in at most l * 4 / 8 bits (the pigeonring
principle). Within such a chain the first segment is equal, so is one of the next two, and so are three of
the first five; which of them, fixes one of five patterns. So the 8 starts and 5 patterns give 40 keys of 24
equal bits, and two fingerprints that link share at least one. Fingerprints that meet under a key are
compared along the ring from the key's start, and a pair goes as soon as a chain exceeds its budget; what
remains after the whole ring is within the 4 bits.

Defined results: a null or wordless text has fingerprint zero and links like any other; equal rows share a
component; a null id is kept and never names a component unless all ids of it are null; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import settle, small_batches, text_key, texts
from tradewind.llm.components import components

SEED = 42
SEGMENTS, MAX_BITS = 8, 4
PATTERNS = ((0, 1, 2), (0, 1, 3), (0, 1, 4), (0, 2, 3), (0, 2, 4))
BUDGETS = np.array([(step + 1) * MAX_BITS // SEGMENTS for step in range(SEGMENTS)], dtype=np.uint8)
# Rows of one key that a task holds; a key with more is split into tiles of two blocks.
BLOCK_ROWS = 8192
# Runs up to this length are compared pair by pair, longer ones by a search that visits each row once.
SHORT_RUN = 24
# What a row of the linker is: a pair of a short run, a key with too many rows, a pair of a long run's spanning set.
LINK, OVER, SPANNING = 0, 1, 2
HASHES_AT_ONCE = 1 << 16
BIT_OF = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.float64)
BYTE_AT = (np.arange(8) * 256).astype(np.int64)


def shingle_hashes(text: bytes, words: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles, repeats included, in bounded pieces."""
    found = text.lower().split()
    if not found:
        return
    count = max(1, len(found) - words + 1)
    line = b" ".join(found)
    lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[:count].tolist()
    stops = (ends[min(words, len(found)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, HASHES_AT_ONCE):
        piece = slice(at, at + HASHES_AT_ONCE)
        yield np.array([digest(line[a:b], SEED) for a, b in zip(starts[piece], stops[piece], strict=True)],
                       dtype=np.uint64)


def bit_weights(hashes: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """For each of the 64 bits, the weight of the hashes that have it set."""
    places = hashes.view(np.uint8).reshape(-1, 8) + BYTE_AT
    each = None if weights is None else np.repeat(weights, 8)
    counts = np.bincount(places.ravel(), weights=each, minlength=2048).reshape(8, 256)
    return (counts @ BIT_OF).ravel()


def majority(weights: np.ndarray, total: float) -> int:
    return int(np.packbits(2 * weights > total, bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, words: int) -> int:
    total, bits = 0, np.zeros(64)
    for hashes in shingle_hashes(text, words):
        bits += bit_weights(hashes)
        total += len(hashes)
    return majority(bits, total) if total else 0


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, print): one row per document; print is the fingerprint's 64 bits as a long."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            prints = [fingerprint(text, words) for text in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["id", "print"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, print long")


def chain_keys() -> Column:
    """The 40 keys of a fingerprint column named print: start and pattern above 24 equal bits."""
    segment = [F.shiftrightunsigned("print", 8 * place).bitwiseAND(F.lit(255)) for place in range(SEGMENTS)]
    keys = []
    for start in range(SEGMENTS):
        for number, pattern in enumerate(PATTERNS):
            key = F.lit((start * len(PATTERNS) + number) << 24)
            for shift, offset in zip((16, 8, 0), pattern, strict=True):
                key = key + F.shiftleft(segment[(start + offset) % SEGMENTS], shift)
            keys.append(key.cast("long"))
    return F.array(*keys)


def _chains_hold(differing: np.ndarray, start: int) -> np.ndarray:
    """Which of the XORs of fingerprint pairs keep within every chain's budget from the start on."""
    left = np.arange(len(differing))
    spent = np.zeros(len(differing), dtype=np.uint8)
    bits = np.bitwise_count(differing.view(np.uint8).reshape(-1, SEGMENTS))
    for step in range(SEGMENTS):
        spent = spent + bits[left, (start + step) % SEGMENTS]
        within = spent <= BUDGETS[step]
        left, spent = left[within], spent[within]
        if not len(left):
            break
    return left


def _short_run_pairs(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of places among rows of equal keys, sorted by key, by comparing at growing distance."""
    starts = (keys >> 24) // len(PATTERNS) % SEGMENTS
    first = np.arange(len(keys) - 1)
    out_a, out_b = [], []
    distance = 1
    while len(first):
        first = first[first + distance < len(keys)]
        first = first[keys[first] == keys[first + distance]]
        for start in np.unique(starts[first]):
            at = first[starts[first] == start]
            hold = _chains_hold(prints[at] ^ prints[at + distance], int(start))
            out_a.append(at[hold])
            out_b.append(at[hold] + distance)
        distance += 1
    return _joined(out_a), _joined(out_b)


def _forest(prints: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever the chains connect in one long run: each row is searched from once."""
    unseen = np.arange(len(prints))
    out_a, out_b = [], []
    queue: list[int] = []
    while len(unseen):
        if not queue:
            queue.append(int(unseen[0]))
            unseen = unseen[1:]
        row = queue.pop()
        hold = _chains_hold(prints[unseen] ^ prints[row], start)
        if len(hold):
            near = unseen[hold]
            out_a.append(np.full(len(near), row))
            out_b.append(near)
            queue.extend(near.tolist())
            unseen = np.delete(unseen, hold)
    return _joined(out_a), _joined(out_b)


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _links_of(keys: np.ndarray, prints: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links among rows sorted by key (and tile), and their kinds: LINK of a short run, SPANNING of a long one."""
    cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1], [True])))
    lengths = np.diff(cuts)
    long_runs = np.flatnonzero(lengths > SHORT_RUN)
    short = np.repeat(lengths <= SHORT_RUN, lengths)
    places = np.flatnonzero(short)
    a, b = _short_run_pairs(keys[places], prints[places])
    out_a, out_b = [nodes[places[a]]], [nodes[places[b]]]
    pairs = len(a)
    for run in long_runs:
        rows = slice(cuts[run], cuts[run + 1])
        a, b = _forest(prints[rows], int(keys[cuts[run]] >> 24) // len(PATTERNS) % SEGMENTS)
        out_a.append(nodes[rows][a])
        out_b.append(nodes[rows][b])
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    low, high = np.minimum(a, b), np.maximum(a, b)
    keep = low != high
    return low[keep], high[keep], np.where(np.arange(len(a)) < pairs, LINK, SPANNING)[keep]


def _runs(batches, at_once: int):
    """Rows of whole keys, gathered from sorted batches; of a key with over BLOCK_ROWS rows only its count."""
    held: list[tuple[np.ndarray, ...]] = []
    count = 0
    over_key, over_count = None, 0

    def split(parts, last: bool):
        keys, tiles, prints, nodes = (np.concatenate(column) for column in zip(*parts, strict=True))
        changes = np.flatnonzero((keys[1:] != keys[:-1]) | (tiles[1:] != tiles[:-1])) + 1
        end = len(keys) if last else (changes[-1] if len(changes) else 0)
        return (keys, tiles, prints, nodes), end, changes

    for batch in batches:
        part = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        if over_key is not None:
            same = (part[0] == over_key[0]) & (part[1] == over_key[1])
            over_count += int(same.sum())
            part = tuple(column[~same] for column in part)
            if len(part[0]):
                yield over_key, over_count
                over_key = None
        if not len(part[0]):
            continue
        held.append(part)
        count += len(part[0])
        if count < at_once:
            continue
        columns, end, _ = split(held, last=False)
        if end:
            yield tuple(column[:end] for column in columns)
            held = [tuple(column[end:] for column in columns)]
            count = len(held[0][0])
        elif columns[1][0] == 0:
            over_key, over_count = (int(columns[0][0]), 0), count
            held, count = [], 0
        else:
            held = [columns]
    if held:
        yield tuple(split(held, last=True)[0])
    if over_key is not None:
        yield over_key, over_count


def _linker(at_once: int):
    """mapInArrow function over rows (key, tile, print, node) sorted by key and tile.

    Gives links (kinds LINK and SPANNING: two nodes) and the keys that need tiles (kind OVER: key and row count).
    """
    def run(batches):
        for found in _runs(batches, at_once):
            if len(found) == 2:
                (key, _), rows = found
                columns = [np.array([OVER]), np.array([key]), np.array([rows])]
            else:
                keys, tiles, prints, nodes = found
                # A run is a key and its tile: make one number of them, start and pattern still on top.
                if tiles.any():
                    parts = []
                    cuts = np.flatnonzero(np.concatenate(
                        ([True], (keys[1:] != keys[:-1]) | (tiles[1:] != tiles[:-1]), [True])))
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        parts.append(_links_of(keys[a:b], prints[a:b], nodes[a:b]))
                    found = [np.concatenate(column) for column in zip(*parts, strict=True)]
                else:
                    found = _links_of(keys, prints, nodes)
                rows = np.unique(np.stack(found, axis=1), axis=0) if len(found[0]) else np.empty((0, 3), np.int64)
                columns = [rows[:, 2], rows[:, 0], rows[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["kind", "a", "b"])

    return run


def links(items: DataFrame, label: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, spanning), a < b: links between items (node long, print long, family int) that connect all whose prints of one
    family differ in at most 4 bits. Short runs give every pair; longer ones a spanning set, which stands for pairs that are
    not there.

    A key with over `block_rows` items is dealt in tiles of two blocks, so that no task gathers it.
    """
    linked = "kind long, a long, b long"
    rows = items.select("node", "print", "family", F.explode(chain_keys()).alias("key")).withColumn(
        "key", F.col("key") + F.col("family").cast("long") * (SEGMENTS * len(PATTERNS) << 24))
    dealt = rows.select("key", F.lit(0).cast("long").alias("tile"), "print", "node")
    first = settle(dealt.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_linker(block_rows), linked),
                   f"{label}-links")
    found = first.where(F.col("kind") != OVER)
    hot = first.where(F.col("kind") == OVER).select(F.col("a").alias("key"), (F.floor(F.col("b") / block_rows) + 1).alias("blocks"))
    if not hot.isEmpty():
        blocked = rows.join(hot, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        tiles = blocked.withColumn("other", other).select(
            "key", (1 + F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("tile"),
            "print", "node")
        more = settle(tiles.repartition("key", "tile").sortWithinPartitions("key", "tile", "node").mapInArrow(
            _linker(block_rows), linked), f"{label}-tiles")
        found = found.unionByName(more.where(F.col("kind") != OVER))
    return found.groupBy("a", "b").agg((F.max("kind") == SPANNING).alias("spanning"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, print, component): every row with its fingerprint and the smallest id that it reaches by links."""
    prints = settle(fingerprints(docs, id_col, text_col, words), "simhash-prints")
    nodes = settle(prints.groupBy("print").agg(F.min("id").alias("least")), "simhash-nodes")
    found = components(links(nodes.select(F.col("print").alias("node"), "print", F.lit(0).alias("family")), "simhash"), "simhash")
    named = nodes.join(found.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    classes = settle(named.join(least, "root").select("print", "component"), "simhash-classes")
    return prints.join(classes, "print").select("id", "print", "component")


# Candidates of near_duplicates: bands of minima, see there.
SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 32, 5
MINIMA_AT_ONCE = 1024
# What a task holds of one long run of texts, in rows and bytes of text; a run with more is split into tiles of two blocks.
OPEN_ROWS, OPEN_BYTES = 1024, 8 << 20
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, (3, BANDS * BAND_ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(text: bytes) -> tuple[int, list[int]]:
    """The text's fingerprint over its shingles, and a key of each band: of the least values that the band's hash functions
    take over them."""
    total, bits = 0, np.zeros(64)
    least = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for hashes in shingle_hashes(text, SHINGLE_WORDS):
        bits += bit_weights(hashes)
        total += len(hashes)
        for at in range(0, len(hashes), MINIMA_AT_ONCE):
            values = np.multiply.outer(hashes[at:at + MINIMA_AT_ONCE], _ODD[0])
            values += _ODD[1]
            np.minimum(least, values.min(axis=0), out=least)
    mixed = (least ^ (least >> np.uint64(31))) * _ODD[2]
    mixed ^= mixed >> np.uint64(29)
    keys = mixed.reshape(BANDS, BAND_ROWS).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()
    return majority(bits, total) if total else 0, keys


def _band_pairs(batches):
    """Of rows (key, node) sorted by both, pairs with equal keys (kind 0), and keys of long runs with their row counts (kind 1).

    Short runs give every pair; a long one only those with its first rows: see _in_long_runs for the others.
    """
    key, held, count = None, [], 0
    for batch in batches:
        found = []
        for now, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if now != key:
                if count > SHORT_RUN:
                    found.append((1, key, count))
                key, held, count = now, [node], 1
                continue
            count += 1
            if count <= SHORT_RUN:
                found.extend((0, other, node) for other in held)
                held.append(node)
            else:
                found.append((0, held[0], node))
        yield _long_columns(found)
    if count > SHORT_RUN:
        yield _long_columns([(1, key, count)])


def _long_columns(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = np.array(found, dtype=np.int64).reshape(-1, 3).T
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["kind", "a", "b"])


def shingle_set(text: bytes, words: int) -> set[bytes]:
    found = text.lower().split()
    return {b" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def _similar(batches):
    """Of rows (a, b, left text, right text), the pairs whose shingle sets are similar enough."""
    for batch in batches:
        keep, last, first = [], None, set()
        for left, right in zip(texts(batch.column(2)), texts(batch.column(3)), strict=True):
            if left != last:
                last, first = left, shingle_set(left, SHINGLE_WORDS)
            second = shingle_set(right, SHINGLE_WORDS)
            common = len(first & second)
            keep.append(common >= SIMILARITY * (len(first) + len(second) - common))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])


def _similar_forest(sets: list[np.ndarray], roots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of similar sets that connect whatever similar pairs connect, given that equal roots are connected."""
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    distinct, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    mine = np.zeros(len(distinct), dtype=bool)
    unseen = np.arange(len(sets))
    out_a, out_b = [], []
    queue: list[int] = []
    while len(unseen):
        if not queue:
            reached = roots[unseen] == roots[unseen[0]]
        else:
            row = queue.pop()
            own = codes[starts[row]:ends[row]]
            mine[own] = True
            before = np.concatenate(([0], np.cumsum(mine[codes])))
            mine[own] = False
            common = before[ends[unseen]] - before[starts[unseen]]
            near = unseen[common >= SIMILARITY * (sizes[row] + sizes[unseen] - common)]
            out_a.append(np.full(len(near), row))
            out_b.append(near)
            reached = np.isin(roots[unseen], roots[near])
        queue.extend(unseen[reached].tolist())
        unseen = unseen[~reached]
    return _joined(out_a), _joined(out_b)


def _similar_in_runs(batches):
    """Of rows (key, tile, node, root, text) sorted by key and tile, links that connect what similar pairs of a tile connect."""
    run, nodes, roots, sets = None, [], [], []

    def found():
        a, b = _similar_forest(sets, np.array(roots)) if len(set(roots)) > 1 else (_joined([]), _joined([]))
        nodes_of = np.array(nodes, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(nodes_of[a]), pa.array(nodes_of[b])], ["a", "b"])

    for batch in batches:
        for key, tile, node, root, text in zip(*[batch.column(i).to_pylist() for i in range(4)], texts(batch.column(4)), strict=True):
            if (key, tile) != run:
                if run is not None:
                    yield found()
                run, nodes, roots, sets = (key, tile), [], [], []
            nodes.append(node)
            roots.append(root)
            sets.append(np.unique(np.concatenate([np.empty(0, np.uint64), *shingle_hashes(text, SHINGLE_WORDS)])))
    if run is not None:
        yield found()


def _in_long_runs(long_runs: DataFrame, found: DataFrame, confirmed: DataFrame) -> DataFrame:
    """(a, b): similar pairs that connect whatever similar pairs of the long runs, (key, node), connect beyond the confirmed
    ones.

    The rows of a run that the confirmed pairs have not made one group are compared by their texts where they meet.
    """
    groups = components(confirmed, "dedup-first")
    members = settle(long_runs.distinct().join(groups, "node", "left").join(
        found.select("node", F.octet_length("text").alias("bytes")), "node").select(
        "key", "node", F.coalesce("root", "node").alias("root"), "bytes"), "dedup-long")
    blocks = F.greatest(F.count("*") / OPEN_ROWS, F.sum("bytes") / OPEN_BYTES)
    unsettled = members.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), (
        F.floor(blocks) + 1).alias("blocks")).where("low < high").select("key", "blocks")
    blocked = members.join(unsettled, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    tiles = blocked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "key", (F.least("block", "other") * F.col("blocks") + F.greatest("block", "other")).alias("tile"), "node", "root")
    return tiles.join(found, "node").select("key", "tile", "node", "root", "text").repartition("key", "tile").sortWithinPartitions(
        "key", "tile").mapInArrow(_similar_in_runs, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of exact or near copies: the one with the smallest id, with the columns of docs.

    Near copies have at least 0.8 of their five-word shingles in common (size of intersection by size of union).
    Candidates are the links of SimHash fingerprints over the shingles, found by pigeonring chains (``links``). These reach
    4 bits, and at similarity 0.8 fingerprints differ in about 10. So bands of minima over the same shingles stand beside
    them: a hash function's least value over two texts is the same with the chance of their similarity, wherever they
    differ, so a pair at 0.8 has no equal band of 32 with the chance (1 - 0.8 ** 5) ** 32, 3 in a million. Candidates of
    either kind are checked against the shingles of both whole texts. The groups are those of all candidate pairs, also
    where so many texts have a band or a chain in common that not every pair is emitted.

    Wordless texts are one group; a null text is as an empty one.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            prints, keys = zip(*map(sketch, texts(batch.column(2))), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.int64()), pa.array(
                keys, pa.list_(pa.int64()))], ["id", "text_key", "print", "keys"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = settle(docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, text_key binary, print long, keys array<long>"), "dedup-keys")
    nodes = settle(rows.groupBy("text_key").agg(F.min("id").alias("least"), F.any_value("print").alias("print"), F.any_value("keys").alias("keys")).withColumn(
        "node", F.monotonically_increasing_id()), "dedup-nodes")
    keyed = nodes.select(F.explode("keys").alias("key"), "node")
    runs = settle(keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(
        _band_pairs, "kind long, a long, b long"), "dedup-runs")
    chained = settle(links(nodes.select("node", "print", F.lit(0).alias("family")), "dedup"), "dedup-chained")
    near = settle(runs.where("kind = 0 and a <> b").select("a", "b").unionByName(chained.select("a", "b")).distinct(), "dedup-candidates")

    concerned = near.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "text_key"), "node")
    found = settle(docs.select(text_key(text_col).alias("text_key"), F.col(text_col).alias("text")).join(
        concerned, "text_key").groupBy("node").agg(F.any_value("text").alias("text")), "dedup-texts")
    left, right = (found.select(F.col("node").alias(side), F.col("text").alias(f"text {side}")) for side in "ab")
    confirmed = near.join(left, "a").join(right, "b").select("a", "b", "text a", "text b").mapInArrow(_similar, "a long, b long")
    long_keys = runs.where("kind = 1").select(F.col("a").alias("key"))
    long_runs = [] if long_keys.isEmpty() else [keyed.join(long_keys, "key")]
    spanning = chained.where("spanning").select("a", "b")
    if not spanning.isEmpty():
        # Every pair that a spanning set stands for lies within what the set connects.
        long_runs.append(components(spanning, "dedup-spanned").select(F.xxhash64(F.lit("spanned"), "root").alias("key"), "node"))
    if long_runs:
        confirmed = settle(confirmed, "dedup-confirmed")
        confirmed = confirmed.unionByName(settle(_in_long_runs(
            functools.reduce(DataFrame.unionByName, long_runs), found, confirmed), "dedup-unsettled"))

    groups = components(confirmed, "dedup").withColumnRenamed("root", "group")
    winners = nodes.join(groups, "node", "left").groupBy(F.coalesce("group", "node").alias("group")).agg(
        F.min(F.struct("least", "text_key")).alias("best")).select(
        F.col("best.least").alias("kept id"), F.col("best.text_key").alias("kept key"))
    winners = settle(winners, "dedup-winners")
    repeated = rows.groupBy("id", "text_key").count().where("count > 1").select(
        F.col("id").alias("kept id"), F.col("text_key").alias("kept key"))

    def same(other: DataFrame):
        return F.col(f"`{id_col}`").eqNullSafe(other["kept id"]) & (text_key(text_col) == other["kept key"])

    kept = docs.join(winners, same(winners), "left_semi")
    again = settle(repeated, "dedup-repeated")
    if again.isEmpty():
        return kept
    # Equal ids with equal texts: one row of them, whichever.
    return kept.join(again, same(again), "left_anti").unionByName(
        kept.join(again, same(again), "left_semi").dropDuplicates([id_col, text_col]))
