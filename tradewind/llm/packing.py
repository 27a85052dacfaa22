"""Packing by lexical retrieval: windows filled with a seed document's BM25 neighbours.

Each document is tokenized once; whole windows of it stand alone, and the remainder is a piece to pack. Pieces
are ranged by a signature of their tokens, the smallest hash, so that like texts come together, and by row, so
that a group of copies spreads over tasks. A task indexes its pieces a shard at a time: an inverted index from
token to the pieces that hold it, with BM25 weights from counts over all documents. The oldest unused piece
seeds a window; the neighbours that its strongest tokens retrieve fill it greedily, the best that fits first; if
none fits, the best is cut, and its rest seeds the next window. So only a task's last window has padding.

Defined results: a null or empty text is the end token alone; equal rows are all packed; a piece that shares no
token with the seed comes after all that do, in order; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradewind.llm.common import byte_batches, settle, small_batches, table_batches
from tradewind.llm.textcuts import coded_pieces

WINDOW = 2048
END = 1
SHARD_PIECES = 4096
QUERY_TOKENS = 24
FIRST = 64
K1, B = 1.2, 0.75
# Pieces that a worker remembers, and the longest of them.
REMEMBERED, REMEMBERED_CHARS = 400_000, 256
# Bytes of text whose different pieces are looked up together.
TEXT_AT_ONCE = 4 << 20
WHITE = regex.compile(r"\s")
# Tokens of a task that packs: enough windows that one partly filled does not count, and few enough for memory.
LEAST_TOKENS, MOST_TOKENS = 128 * WINDOW, 1 << 24
FULL, REST, COUNTS = 0, 1, 2
PIECE_SCHEMA = ("kind int, row long, doc_id {id}, start long, length long, doc_tokens long, signature long, "
                "sequence_id long, ids_crc32 long, ids binary")
PIECE_NAMES = ["kind", "row", "doc_id", "start", "length", "doc_tokens", "signature", "sequence_id", "ids_crc32", "ids"]


class Tokens:
    """A tokenizer that remembers the pieces it has met; ids come as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.size = self.tokenizer.get_vocab_size()
        # Ids lie in two bytes in the tables between the steps, if they fit.
        self.stored = "<u2" if self.size <= 1 << 16 else "<u4"
        # A byte-level token has one character for each of its bytes.
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.size)])
        self.known: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        """Encode pieces, those that end in a word a stretch at a time: the pattern has a boundary in front of the
        white space behind a word, so tokens do not cross there and their bytes tell whose they are."""
        alone = [piece for piece in new if piece[-1].isspace()]
        glued = [piece for piece in new if not piece[-1].isspace()]
        # A piece without white space in front gets a line break, which is a token of its own there.
        led = [piece if piece[0] in " \n" or WHITE.match(piece) else f"\n{piece}" for piece in glued]
        stretches = [slice(at, at + 2048) for at in range(0, len(led), 2048)]
        coded = self.tokenizer.encode_batch_fast(["".join(led[part]) for part in stretches], add_special_tokens=False)
        for part, found in zip(stretches, coded, strict=True):
            ids = np.array(found.ids, dtype="<u4")
            ends = np.cumsum(pc.binary_length(pa.array(led[part], pa.string())).to_numpy(), dtype=np.int64)
            sizes = np.cumsum(self.bytes_of[ids])
            last = np.searchsorted(sizes, ends)
            if not np.array_equal(sizes[last], ends):
                alone += glued[part]
                continue
            stops = (4 * (last + 1)).tolist()
            data, start = ids.tobytes(), 0
            for piece, lead, stop in zip(glued[part], led[part], stops, strict=True):
                self.known[piece] = data[start + 4 * (lead is not piece):stop]
                start = stop
        for piece, found in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False), strict=True):
            self.known[piece] = np.array(found.ids, dtype="<u4").tobytes()

    def encode(self, column: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        found, numbers, firsts = coded_pieces(column)
        if len(self.known) > REMEMBERED:
            self.known = {piece: self.known[piece] for piece in found if piece in self.known}
        self.known[""] = b""
        own = list(map(self.known.get, found))
        new = [n for n, ids in enumerate(own) if ids is None]
        self._learn([found[n] for n in new])
        for n in new:
            own[n] = self.known[found[n]]
            if len(found[n]) > REMEMBERED_CHARS:
                del self.known[found[n]]
        coded = pa.array(own, pa.large_binary()).take(pa.array(numbers))
        places = np.frombuffer(coded.buffers()[1], dtype=np.int64)[coded.offset:] // 4
        data = coded.buffers()[2]
        ids = np.frombuffer(data if data is not None else b"", dtype="<u4")
        edges = places[firsts].tolist()
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


@functools.lru_cache(maxsize=1)
def _tokens(path: str) -> Tokens:
    return Tokens(path)


def _mixed(ids: np.ndarray) -> np.ndarray:
    mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed ^ (mixed >> np.uint64(29))


def _tokenized(docs: DataFrame, path: str, window: int, id_col: str, text_col: str) -> DataFrame:
    """Pieces of every document, and per task a row with each token's document count, the documents and tokens."""
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    kind_of_id = to_arrow_type(docs.schema[id_col].dataType)

    def run(batches):
        coder = _tokens(path)
        counts = np.zeros(coder.size + 2, dtype=np.int64)
        row = sequence = TaskContext.get().partitionId() << 33
        for table in byte_batches(batches, TEXT_AT_ONCE):
            out: list[tuple] = []
            for doc_id, coded in zip(table.column(0).to_pylist(), coder.encode(table.column(1).combine_chunks()), strict=True):
                ids = np.append(coded, np.uint32(END)).astype("<u4")
                own = np.unique(ids)
                counts[own] += 1
                counts[-2] += 1
                counts[-1] += len(ids)
                signature = int(_mixed(own).min() >> np.uint64(1))
                for at in range(0, len(ids), window):
                    part = ids[at:at + window]
                    full = len(part) == window
                    out.append((FULL if full else REST, row, doc_id, at, len(part), len(ids), signature,
                                2 * sequence if full else None, zlib.crc32(part.tobytes()), part.astype(coder.stored).tobytes()))
                    row += 1
                    sequence += full
            if out:
                yield _batch(out, kind_of_id)
            pa.default_memory_pool().release_unused()
        yield _batch([(COUNTS, row, None, 0, 0, 0, 0, None, 0, counts.tobytes())], kind_of_id)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, PIECE_SCHEMA.format(id=id_type))


def _batch(rows: list[tuple], kind_of_id: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), kind_of_id, *[pa.int64()] * 6, pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], PIECE_NAMES)


def _document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Each token's document count over the whole corpus, then the documents and tokens: bounded by the vocabulary."""
    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.frombuffer(data, dtype=np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["token", "n"])

    summed = rows.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(size, dtype=np.int64)
    total[summed["token"].to_numpy()] = summed["n"].to_numpy()
    return total


class _Shard:
    """An inverted index over some pieces; gives unused neighbours of a piece, best first."""

    def __init__(self, held: list, idf: np.ndarray, mean_length: float):
        self.held, self.unused = held, np.ones(len(held), dtype=bool)
        tokens, owners, weights, self.queries = [], [], [], []
        for place, (_, _, ids, _) in enumerate(held):
            own, times = np.unique(ids, return_counts=True)
            weight = idf[own] * times * (K1 + 1) / (times + K1 * (1 - B + B * len(ids) / mean_length))
            tokens.append(own)
            weights.append(weight)
            owners.append(np.full(len(own), place))
            best = np.argpartition(-weight, QUERY_TOKENS)[:QUERY_TOKENS] if len(own) > QUERY_TOKENS else slice(None)
            self.queries.append(own[best])
        token, owner, weight = np.concatenate(tokens), np.concatenate(owners), np.concatenate(weights)
        order = np.argsort(token, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.starts = np.searchsorted(token[order], np.arange(len(idf) + 1))
        self.lengths = np.array([len(ids) for _, _, ids, _ in held])

    def neighbours(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        """The unused neighbours in two parts: the FIRST best, and more with the last one's score, best first; and the
        others, whose order `by_score` gives, as most windows are full before."""
        parts = [slice(self.starts[token], self.starts[token + 1]) for token in self.queries[place]]
        self.scores = np.bincount(np.concatenate([self.owner[p] for p in parts]),
                                  weights=np.concatenate([self.weight[p] for p in parts]), minlength=len(self.held))
        near = np.flatnonzero((self.scores > 0) & self.unused)
        if len(near) <= FIRST:
            return self.by_score(near), near[:0]
        own = self.scores[near]
        first = own >= np.partition(own, len(own) - FIRST)[len(own) - FIRST]
        return self.by_score(near[first]), near[~first]

    def by_score(self, near: np.ndarray) -> np.ndarray:
        return near[np.argsort(-self.scores[near], kind="stable")]


def _packer(frequencies, window: int, stored: str):
    """mapInArrow function over pieces in signature order."""
    def run(batches):
        counts = frequencies.value
        documents, tokens = max(1, counts[-2]), counts[-1]
        idf = np.log1p((documents - counts[:-2] + 0.5) / (counts[:-2] + 0.5))
        sequence = (TaskContext.get().partitionId() << 33) * 2 + 1
        filled = 0
        out: list[tuple] = []
        kind_of_id = pa.int64()

        def place(piece, length: int):
            """Put the first ids of a piece into the open window; gives what is left of it."""
            nonlocal sequence, filled
            doc_id, start, ids, doc_tokens = piece
            data = ids[:length].astype("<u4").tobytes()
            out.append((REST, 0, doc_id, start, length, doc_tokens, filled, sequence, zlib.crc32(data), ids[:length].tobytes()))
            filled += length
            if filled == window:
                sequence, filled = sequence + 2, 0
            return (doc_id, start + length, ids[length:], doc_tokens) if length < len(ids) else None

        rest = None
        for table in table_batches(batches, SHARD_PIECES):
            kind_of_id = table.column(0).type
            held = list(zip(table.column(0).to_pylist(), table.column(1).to_pylist(),
                            [np.frombuffer(data, dtype=stored) for data in table.column(3).to_pylist()],
                            table.column(2).to_pylist(), strict=True))
            shard = _Shard(held, idf, max(1.0, tokens / documents))
            seed, oldest = None, 0
            while True:
                if rest is not None:
                    # The rest of a cut piece seeds the window; its neighbours are those of the piece, if it is here.
                    piece, rest = rest, None
                    rest = place(piece, min(len(piece[2]), window - filled))
                else:
                    while oldest < len(held) and not shard.unused[oldest]:
                        oldest += 1
                    if oldest == len(held):
                        break
                    seed = oldest
                    shard.unused[seed] = False
                    rest = place(held[seed], min(len(held[seed][2]), window - filled))
                if rest is not None or not filled or seed is None:
                    continue
                near, more = shard.neighbours(seed)
                while filled and (len(near) or len(more)):
                    room = window - filled
                    fits = np.flatnonzero(shard.lengths[near] <= room)
                    if not len(fits) and len(more):
                        near, more = np.concatenate([near, shard.by_score(more)]), more[:0]
                        continue
                    take = fits[0] if len(fits) else 0
                    chosen = int(near[take])
                    shard.unused[chosen] = False
                    near = np.delete(near, take)
                    rest = place(held[chosen], min(len(held[chosen][2]), room))
                    if rest is not None:
                        seed = chosen
            if len(out):
                yield _batch(out, kind_of_id)
                out = []
        if rest is not None:
            while rest is not None:
                rest = place(rest, min(len(rest[2]), window - filled))
        if out:
            yield _batch(out, kind_of_id)

    return run


def _widened(packed: DataFrame, stored: str) -> DataFrame:
    """Ids as little-endian unsigned 32-bit."""
    def run(batches):
        for batch in batches:
            ids = [np.frombuffer(data, dtype=stored).astype("<u4").tobytes() for data in batch.column("ids").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids", pa.array(ids, pa.binary()))

    return packed.mapInArrow(run, packed.schema) if stored != "<u4" else packed


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         with_ids: bool = True) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids_crc32, ids): every piece, its document's ids
    from start on, and its place in a sequence of at most `window` ids. ids are little-endian unsigned 32-bit; without
    `with_ids` they are left out."""
    spark = docs.sparkSession
    stored = _tokens(tokenizer_path).stored
    made = settle(_tokenized(docs, tokenizer_path, window, id_col, text_col), "pack-pieces")
    id_type = made.schema["doc_id"].dataType.simpleString()
    frequencies = spark.sparkContext.broadcast(
        _document_counts(made.where(F.col("kind") == COUNTS), _tokens(tokenizer_path).size + 2))
    rests = made.where(F.col("kind") == REST)
    tokens = rests.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    wanted = min(int(spark.conf.get("spark.sql.shuffle.partitions")), tokens // LEAST_TOKENS)
    parts = max(1, wanted, -(-tokens // MOST_TOKENS))
    packed = settle(rests.select("doc_id", "start", "doc_tokens", "ids", "signature", "row").repartitionByRange(
        parts, "signature", "row").sortWithinPartitions("signature", "row").drop("signature", "row").mapInArrow(
        _packer(frequencies, window, stored), PIECE_SCHEMA.format(id=id_type)), "pack-packed")
    # In packed rows the signature's place holds the offset.
    columns = ["doc_id", "start", "length", "doc_tokens", "sequence_id"]
    found = made.where(F.col("kind") == FULL).select(*columns, F.lit(0).cast("long").alias("offset"), "ids_crc32", "ids").union(
        packed.select(*columns, F.col("signature").alias("offset"), "ids_crc32", "ids"))
    return _widened(found, stored) if with_ids else found.drop("ids")
