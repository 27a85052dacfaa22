"""Benchmark decontamination by winnowing.

Every window of 10 words has a fingerprint: the smallest hash of its runs of 6 words. Neighbouring windows mostly
have the same one, so a text keeps about a third as many different fingerprints as it has words, and two texts that
share 10 words in a row keep a fingerprint in common whatever stands around: no long enough shared span is lost.

Fingerprints of the benchmark go into a bit filter of bounded size. A task looks up those of its documents as it
reads them, so that nothing of a clean document is shuffled. What passes is extended: each window of the fingerprint
comes with the MD5 of its words, and documents and benchmark are joined on fingerprint and extension together. The
benchmark's side has one row per different window, so that a passage that many items and many documents share
makes no pairs of documents and items; it is salted against passages that a large share of the documents hold. The
windows' items are gathered per set of windows and not per document, so that copies and documents with the same
passages share that work.

A shorter item is one window of all its words; fingerprints of 6 words give no guarantee there, so for each length
of such items (nine at most) every run of that many words is looked up.

Defined results: a null or empty text has no words; an item without words is no item; equal rows are all judged;
items with one id count once, and a null id counts as the empty string; extra columns, whatever their names, are not
read; a long text is one row of arrays as long as its words; an empty benchmark leaves every document clean. What
grows with the benchmark on a single machine is the list of items that one set of windows holds, which the result
digests as one string.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradewind.llm.common import settle, small_batches
from tradewind.llm.words import Words, gram_hashes, mixed, word_hashes, words_of

WINDOW = 10
PRINT_WORDS = 6
# Copies of the benchmark's side of the join: a passage that many documents hold is met in so many tasks.
SALTS = 16
# Bits of the filter: 16 for each entry, in these bounds (8 KB to 32 MB). A full filter lets more rows reach the join.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
SPAN = pa.struct([("print", pa.int64()), ("words", pa.binary()), ("at", pa.int32()), ("size", pa.int32())])


class Spans:
    """Windows of some texts: the text, the first word, the length in words, the fingerprint and all words' hash."""

    def __init__(self, words: Words, sizes: list[int], window: int, print_words: int):
        hashes, owner, counts = word_hashes(words), words.owners(), words.counts
        self.words = words
        parts = []
        for size in sizes:
            whole = gram_hashes(hashes, size)
            if not len(whole):
                continue
            print_ = whole
            if size == window and print_words < window:
                grams = gram_hashes(hashes, print_words)
                print_ = grams[:len(whole)]
                for later in range(1, window - print_words + 1):
                    print_ = np.minimum(print_, grams[later:later + len(whole)])
            at = np.flatnonzero(owner[:len(whole)] == owner[size - 1:])
            parts.append((at, np.full(len(at), size), print_[at], whole[at]))
        columns = zip(*parts, strict=True) if parts else ([np.empty(0, dtype=np.int64)],) * 2 + ([np.empty(0, dtype=np.uint64)],) * 2
        self.at, self.size, self.print, self.whole = (np.concatenate(part) for part in columns)
        self.owner = owner[self.at] if len(owner) else self.at
        self.counts = counts

    def keep(self, chosen: np.ndarray) -> None:
        for name in ("at", "size", "print", "whole", "owner"):
            setattr(self, name, getattr(self, name)[chosen])

    def digests(self) -> list[bytes]:
        """The MD5 of each window's words: their lengths and bytes."""
        offsets, data = self.words.offsets, self.words.data.tobytes()
        out = []
        for at, size in zip(self.at.tolist(), self.size.tolist(), strict=True):
            edge = offsets[at:at + size + 1]
            out.append(hashlib.md5(np.diff(edge).tobytes() + data[edge[0]:edge[-1]], usedforsecurity=False).digest())
        return out


def _probes(values: np.ndarray, bits: int) -> list[np.ndarray]:
    again = mixed(values)
    return [(v & np.uint64(bits - 1)).astype(np.int64) for v in (values, again, again >> np.uint64(32))]


def _holds(filter_bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each value."""
    found = np.ones(len(values), dtype=bool)
    for probe in _probes(values, 8 * len(filter_bits)):
        found &= (filter_bits[probe >> 3] >> (probe & 7).astype(np.uint8)) & 1 == 1
    return found


def _item_windows(items: DataFrame, id_col: str, text_col: str, window: int, print_words: int) -> DataFrame:
    """(item, print, words, size, whole): every window of every item."""
    def run(batches):
        for batch in batches:
            words = words_of(batch.column(1))
            spans = Spans(words, list(range(1, window + 1)), window, print_words)
            # Of an item with fewer words than a window only the run of all its words counts.
            spans.keep(spans.size == np.minimum(spans.counts[spans.owner], window))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(spans.owner)), pa.array(spans.print.view(np.int64)),
                 pa.array(spans.digests(), pa.binary()), pa.array(spans.size, pa.int32()),
                 pa.array(spans.whole.view(np.int64))], ["item", "print", "words", "size", "whole"])

    item = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("item")
    return items.select(item, F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "item string, print long, words binary, size int, whole long")


def _bit_filter(values: DataFrame, bits: int) -> np.ndarray:
    """The filter over a column of 64-bit values, put together from the words that have a bit: bounded by `bits`."""
    def run(batches):
        own = np.zeros(bits // 8, dtype=np.uint8)
        for batch in batches:
            for probe in _probes(batch.column(0).to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(own, probe >> 3, np.left_shift(1, probe & 7).astype(np.uint8))
        filled = own.view(np.int64)
        at = np.flatnonzero(filled)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(filled[at])], ["at", "bits"])

    found = values.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    whole = np.zeros(bits // 64, dtype=np.int64)
    whole[found["at"].to_numpy()] = found["bits"].to_numpy()
    return whole.view(np.uint8)


def _document_spans(docs: DataFrame, filters, sizes: list[int], id_col: str, text_col: str, window: int,
                    print_words: int) -> DataFrame:
    """(row, doc_id, n_words, spans): every document, with the windows that the filters let through."""
    id_type = docs.schema[id_col].dataType
    kind_of_id = to_arrow_type(id_type)

    def run(batches):
        prints, wholes = filters.value
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            words = words_of(batch.column(1))
            spans = Spans(words, sizes, window, print_words)
            if len(spans.print):
                # Neighbours mostly share their fingerprint: look up the first of each run.
                first = np.concatenate(([True], spans.print[1:] != spans.print[:-1]))
                spans.keep(_holds(prints, spans.print[first])[np.cumsum(first) - 1])
                spans.keep(_holds(wholes, spans.whole))
                spans.keep(np.lexsort((spans.at, spans.owner)))
            cuts = np.searchsorted(spans.owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            found = pa.StructArray.from_arrays(
                [pa.array(spans.print.view(np.int64)), pa.array(spans.digests(), pa.binary()),
                 pa.array(spans.at - words.firsts[spans.owner], pa.int32()), pa.array(spans.size, pa.int32())],
                fields=list(SPAN))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + batch.num_rows)), batch.column(0).cast(kind_of_id),
                 pa.array(spans.counts, pa.int64()), pa.ListArray.from_arrays(pa.array(cuts), found)],
                ["row", "doc_id", "n_words", "spans"])
            row += batch.num_rows

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, f"row long, doc_id {id_type.simpleString()}, n_words long, "
             "spans array<struct<print: long, words: binary, at: int, size: int>>")


def _merge(batches):
    """Sorted windows of each document to the spans that they cover."""
    for batch in batches:
        found = batch.column("found")
        cuts = found.offsets.to_numpy() - found.offsets[0].as_py()
        inner = found.flatten()
        start, size = inner.field("at").to_numpy(), inner.field("size").to_numpy()
        counts, starts, stops, covered = [], [], [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            begin, reach = start[a:b], np.maximum.accumulate(start[a:b] + size[a:b])
            opens = np.flatnonzero(np.append(True, begin[1:] > reach[:-1]))
            starts.append(begin[opens])
            stops.append(reach[np.append(opens[1:] - 1, b - a - 1)])
            counts.append(len(opens))
            covered.append(int((stops[-1] - starts[-1]).sum()))
        hits = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()),
            pa.StructArray.from_arrays([pa.array(np.concatenate([*starts, np.empty(0, dtype=np.int32)]), pa.int32()),
                                        pa.array(np.concatenate([*stops, np.empty(0, dtype=np.int32)]), pa.int32())], ["start", "stop"]))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(covered, pa.int64()), hits, batch.column("sets"),
                                          batch.column("held")], ["row", "n_hit", "hits", "sets", "held"])


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, print_words: int = PRINT_WORDS,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits): every document, its words inside any
    occurrence of a window of an item, and the items that have such windows. `hits` lists the spans of words that
    are hit, as array<struct<start, stop>>, merged and in order, for cutting them out."""
    spark = docs.sparkSession
    small_batches(spark)
    windows = settle(_item_windows(items, item_col, item_text_col, window, print_words), "benchmark-windows")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())
    entries = windows.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * entries).bit_length()))
    filters = spark.sparkContext.broadcast((_bit_filter(windows.select("print"), bits), _bit_filter(windows.select("whole"), bits)))

    # The different sets of items that windows have, and each different window with its set.
    key = ["print", "words", "size"]
    sets = windows.groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    sets = settle(sets.withColumn("set", F.md5(F.to_json("items"))), "benchmark-sets")
    members = sets.groupBy("set").agg(F.first("items").alias("items"))
    salted = sets.select(*key, "set", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))

    made = settle(_document_spans(docs, filters, sizes, id_col, text_col, window, print_words), "document-spans")
    some = F.size("spans") > 0
    spans = made.where(some).select("row", F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"),
                                    F.explode("spans").alias("span")).select("row", "salt", "span.*")
    matched = spans.join(salted, [*key, "salt"]).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("at", "size"))).alias("found"), F.array_sort(F.collect_set("set")).alias("sets"))
    matched = settle(matched.select("row", "found", "sets", F.md5(F.to_json("sets")).alias("held")).mapInArrow(
        _merge, "row long, n_hit long, hits array<struct<start: int, stop: int>>, sets array<string>, held string"),
        "document-hits")

    held = matched.select("held", "sets").dropDuplicates(["held"]).select("held", F.explode("sets").alias("set"))
    listed = held.join(members, "set").select("held", F.explode("items").alias("item")).distinct().groupBy("held").agg(
        F.array_sort(F.collect_list("item")).alias("items"))
    listed = listed.select("held", F.size("items").cast("long").alias("n_items"),
                           F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    found = matched.drop("sets").join(listed, "held").drop("held")

    nothing = F.array().cast("array<struct<start: int, stop: int>>")
    base = ["doc_id", "n_words"]
    clean = made.where(~some).select(*base, F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                                     F.sha2(F.lit(""), 256).alias("items_sha256"), F.lit(False).alias("contaminated"),
                                     nothing.alias("hits"))
    judged = made.where(some).select("row", *base).join(found, "row", "left").select(
        *base, F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("hits").isNotNull().alias("contaminated"), F.coalesce("hits", nothing).alias("hits"))
    return clean.unionByName(judged)
