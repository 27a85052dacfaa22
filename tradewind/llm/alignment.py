"""Alignment of two tokenizers' tokens over the same text.

A text, with a space in front, is encoded by a byte-level BPE (A) and by a sentencepiece BPE (B). Where both end a
token at one byte the text is cut into groups, and the two tokens that end there are linked. Places come from the
tokenizers themselves: the character offsets of A and the spans of B's proto are coarse cuts; inside a character of
several bytes, and among byte-fallback tokens, which the proto gives an empty span, the decoded bytes refine them.

No token of either vocabulary crosses from a word to the space, line break, comma or full stop behind it (checked when
the vocabularies are read), so a text falls apart in front of those, each distinct part is aligned once per worker, and
a long text is only many parts. A text without such places is one part.

Links are counted over the corpus by pair of ids. Two tokens that end together have one's bytes at the end of the
other's, so the vocabularies alone bound the different pairs (some 100,000 here): each task counts into an array
of that size, and the sum comes back to the tasks as a broadcast of that size.

The installed sentencepiece no longer has immutable protos; its proto of the same content is read instead.

Defined results: a null or empty text, and one whose tokens do not give back its bytes (U+2581 in the text, which B
writes as a space), has no tokens: zeros, and '' for the digest; equal rows are all aligned and all counted; ties for
a B id's highest count are all best; an empty table gives no rows; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradewind.llm.common import byte_batches, settle, small_batches
from tradewind.llm.textcuts import coded_pieces

# Parts that a worker remembers, the longest of them, and how many are encoded in one call.
REMEMBERED = 600_000
REMEMBERED_CHARS = 64
PARTS_AT_ONCE = 8192
# Bytes of text whose different parts are looked up together.
TEXT_AT_ONCE = 16 << 20
# A text that is not cut by replacing marks alone: as in textcuts, with decimal digits for numbers.
IRREGULAR_COLUMN = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}][ \n]|\x00|[^\p{L}\p{Nd}][.,]"
CUT = re.compile(r"(?<=\S)(?=[ \n])")
ROWS, COUNTS = 0, 1
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 as it is, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(sorted({*range(256)} - {*plain}))}


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        added = {i for i, token in self.a.get_added_tokens_decoder().items() if token.special}
        self.a_bytes = [b"" if i in added else bytes([letters[c] for c in self.a.id_to_token(i) or ""])
                        for i in range(self.a.get_vocab_size())]
        count = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(count)]
        self.b_bytes = [bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else
                        b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace("▁", " ").encode()
                        for i, piece in enumerate(pieces)]
        tokens = [token.decode(errors="ignore") for i, token in enumerate(self.b_bytes) if not self.b.is_byte(i)]
        crossing = regex.compile(r"\n|[^ ] |[\p{L}\p{Nd}][.,]")
        self.parts_stand_alone = not any(crossing.search(token) for token in tokens)
        self.a_sizes, self.b_sizes = (np.array([len(token) for token in own]) for own in (self.a_bytes, self.b_bytes))
        self.keys = self._possible()
        most = max(len(self.a_bytes), len(self.b_bytes))
        self.digits = np.array([len(str(i)) for i in range(most)])
        self.marked = [f"{i}{mark}" for mark in ",|;" for i in range(most)]
        self.known: dict[str, tuple] = {}

    def _possible(self) -> np.ndarray:
        """Sorted keys of all pairs of ids of which one's bytes end with the other's."""
        keys: set[int] = set()
        by_bytes: tuple[dict, dict] = ({}, {})
        for own, tokens in zip(by_bytes, (self.a_bytes, self.b_bytes), strict=True):
            for i, token in enumerate(tokens):
                if token:
                    own.setdefault(token, []).append(i)
        for token, mine in by_bytes[0].items():
            for at in range(len(token)):
                keys.update(self.key(a, b) for b in by_bytes[1].get(token[at:], ()) for a in mine)
        for token, mine in by_bytes[1].items():
            for at in range(1, len(token)):
                keys.update(self.key(a, b) for a in by_bytes[0].get(token[at:], ()) for b in mine)
        return np.array(sorted(keys), dtype=np.int64)

    def key(self, a, b):
        return a * len(self.b_bytes) + b

    def learn(self, parts: list[str]) -> None:
        for at in range(0, len(parts), PARTS_AT_ONCE):
            self._align(parts[at:at + PARTS_AT_ONCE])

    def _align(self, parts: list[str]) -> None:
        """Align parts, each encoded by itself, and remember (A tokens, B tokens, groups, their text, links); () where
        the bytes differ.

        B puts a space in front of what it encodes: a part that begins with a space is given without it. Any other
        gets a line break in front, if it has none, whose token is never part of a longer one; it and the space go.
        """
        data = [part.encode() for part in parts]
        sizes = np.fromiter(map(len, data), dtype=np.int64, count=len(parts))
        base = np.cumsum(sizes) - sizes
        coded = self.a.encode_batch(parts, add_special_tokens=False)
        a_ids, a_unit = _flat([c.ids for c in coded])
        spans = _rows([c.offsets for c in coded], len(a_ids), 2)
        # Characters to bytes: the bytes that begin a character, over all parts, and each part's first character.
        heads = np.append(np.flatnonzero((np.frombuffer(b"".join(data), dtype=np.uint8) & 0xC0) != 0x80), sizes.sum())
        first_char = np.searchsorted(heads, base)
        stops = heads[first_char[a_unit] + spans[:, 1]]
        a_sizes = self.a_sizes[a_ids]
        # A token whose successor begins before its last character ends lies inside that character.
        inside = np.append((spans[1:, 0] < spans[:-1, 1]) & (a_unit[1:] == a_unit[:-1]), False)
        a_ends = np.where(inside, _within(a_sizes, a_unit, base), stops)

        given = [(part[1:] or "\n") if part[0] == " " else part if part[0] == "\n" else f"\n{part}" for part in parts]
        skip = [0 if part[0] == " " else 1 if part[0] == "\n" else 2 for part in parts]
        protos = self.b.encode(given, return_type="proto", num_threads=1)
        pieces = [list(proto.pieces)[n:] if part != " " else proto.pieces[:1]
                  for proto, n, part in zip(protos, skip, parts, strict=True)]
        counts = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        b_unit = np.repeat(np.arange(len(parts)), counts)
        b_ids, begins, ends = _rows([[(piece.id, piece.begin, piece.end) for piece in own] for own in pieces], len(b_unit), 3).T
        # Bytes in front that the given text has more, or fewer, than the part.
        lead = np.array([1 if part[0] == " " else 0 if part[0] == "\n" else -1 for part in parts])
        # Byte-fallback tokens have an empty span but for the last of a character, and so has the space in front.
        b_ends = np.where(begins == ends, _within(self.b_sizes[b_ids], b_unit, base), (base + lead)[b_unit] + ends)

        good = self._same_bytes(self.a_bytes, a_ids, a_unit, data) & self._same_bytes(self.b_bytes, b_ids, b_unit, data)
        kept_a, kept_b = np.flatnonzero(good[a_unit]), np.flatnonzero(good[b_unit])
        _, at_a, at_b = np.intersect1d(a_ends[kept_a], b_ends[kept_b], assume_unique=True, return_indices=True)
        last_a, last_b = kept_a[at_a], kept_b[at_b]
        links = np.searchsorted(self.keys, self.key(a_ids[last_a], b_ids[last_b])).astype("<u4").tobytes()
        # All groups' tokens in order, each with the mark behind it: a comma, or | and ; after a group's last.
        group_a, group_b = np.searchsorted(last_a, kept_a), np.searchsorted(last_b, kept_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        ids = np.concatenate([a_ids[kept_a], b_ids[kept_b]])[order]
        is_last = np.concatenate([np.isin(kept_a, last_a), np.isin(kept_b, last_b)])[order]
        is_b = (order >= len(kept_a))
        behind = np.where(is_last, 1 + is_b, 0)
        written = [self.marked[n] for n in (len(self.digits) * behind + ids).tolist()]
        places = np.append(0, np.cumsum(self.digits[ids] + 1))
        units = np.concatenate([a_unit[kept_a], b_unit[kept_b]])[order]
        edges = places[np.searchsorted(units, np.arange(len(parts) + 1))].tolist()
        text = "".join(written)
        sizes = [np.diff(np.searchsorted(unit, np.arange(len(parts) + 1))).tolist() for unit in (a_unit, b_unit)]
        firsts = np.searchsorted(a_unit[last_a], np.arange(len(parts) + 1)).tolist()
        for n, (part, fine) in enumerate(zip(parts, good.tolist(), strict=True)):
            self.known[part] = (sizes[0][n], sizes[1][n], firsts[n + 1] - firsts[n], text[edges[n]:edges[n + 1] - 1],
                                links[4 * firsts[n]:4 * firsts[n + 1]]) if fine else ()

    @staticmethod
    def _same_bytes(tokens: list[bytes], ids: np.ndarray, unit: np.ndarray, data: list[bytes]) -> np.ndarray:
        """Whether each part's tokens give back its bytes."""
        own = [tokens[i] for i in ids.tolist()]
        cuts = np.searchsorted(unit, np.arange(len(data) + 1))
        ends = np.append(0, np.cumsum(np.fromiter(map(len, own), dtype=np.int64, count=len(own))))[cuts]
        if np.array_equal(np.diff(ends), [len(text) for text in data]) and b"".join(own) == b"".join(data):
            return np.ones(len(data), dtype=bool)
        cuts = cuts.tolist()
        return np.array([b"".join(own[x:y]) == text for x, y, text in zip(cuts[:-1], cuts[1:], data, strict=True)], dtype=bool)

    def texts(self, column: pa.Array) -> list[tuple]:
        """For each text (A tokens, B tokens, groups, digest, links); zeros where there are none."""
        column = column.cast(pa.large_string()).fill_null("")
        column = pc.if_else(pc.equal(column, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), column,
                                                                                   pa.scalar("", pa.large_string())))
        if self.parts_stand_alone:
            found, numbers, firsts = coded_pieces(column, IRREGULAR_COLUMN, CUT.split)
        else:
            found, numbers, firsts = column.to_pylist(), np.arange(len(column)), np.arange(len(column) + 1)
        if len(self.known) > REMEMBERED:
            self.known = {part: self.known[part] for part in found if part in self.known}
        self.known[""] = (0, 0, 0, "", b"")
        self.learn(list({part for part in found if part not in self.known}))
        own = [self.known[part] for part in found]
        bad = np.array([not part for part in own], dtype=bool)
        counts = np.array([part[:3] or (0, 0, 0) for part in own], dtype=np.int64).reshape(-1, 3)
        groups, links = ([part[n] if part else part for part in own] for n in (3, 4))
        out = []
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            mine = numbers[a:b]
            total = counts[mine].sum(axis=0).tolist() if not bad[mine].any() else [0]
            if not total[0]:
                out.append((0, 0, 0, "", b""))
                continue
            listed = mine[counts[mine, 2] > 0].tolist()
            digest = hashlib.sha256(";".join([groups[n] for n in listed]).encode()).hexdigest()
            out.append((*total, digest, b"".join([links[n] for n in listed])))
        for part in found:
            if len(part) > REMEMBERED_CHARS:
                self.known.pop(part, None)
        return out


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """Values one after another, and the list that each is of."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    flat = np.fromiter(itertools.chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum()))
    return flat, np.repeat(np.arange(len(lists)), sizes)


def _rows(lists: list, count: int, width: int) -> np.ndarray:
    """Tuples of integers of several lists as the rows of one array."""
    values = itertools.chain.from_iterable(itertools.chain.from_iterable(lists))
    return np.fromiter(values, dtype=np.int64, count=count * width).reshape(-1, width)


def _within(sizes: np.ndarray, unit: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Where each token ends by the decoded bytes of its part's tokens up to it."""
    total = np.cumsum(sizes)
    first = np.searchsorted(unit, np.arange(len(base)))
    before = np.append(0, total)[first]
    return total - before[unit] + base[unit]


@functools.lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str) -> DataFrame:
    """A row for every document with its links as places in the table of pairs, and one per task with their counts."""
    id_type = docs.schema[id_col].dataType
    kinds = [pa.int32(), to_arrow_type(id_type), *[pa.int64()] * 4, pa.string(), pa.binary()]
    names = ["kind", *COLUMNS, "links"]

    def rows(columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    def run(batches):
        own = aligner(a_path, b_path)
        counts = np.zeros(len(own.keys), dtype=np.int64)
        for batch in byte_batches(batches, TEXT_AT_ONCE):
            found = own.texts(batch.column(1).combine_chunks())
            links = [row[4] for row in found]
            counts += np.bincount(np.frombuffer(b"".join(links), dtype="<u4"), minlength=len(counts))
            n_a, n_b, groups, digests = ([row[n] for row in found] for n in range(4))
            yield rows([[ROWS] * len(found), batch.column(0).to_pylist(), n_a, n_b, groups, [len(x) // 4 for x in links],
                        digests, links])
        yield rows([[COUNTS], [None], [0], [0], [0], [0], [""], [counts.tobytes()]])

    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, f"kind int, doc_id {id_type.simpleString()}, n_a long, n_b long, n_groups long, n_links long, "
             "groups_sha256 string, links binary")


def _pair_counts(made: DataFrame, size: int) -> np.ndarray:
    """Links of each possible pair over the corpus."""
    def run(batches):
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.frombuffer(data, dtype=np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["pair", "n"])

    summed = made.where(F.col("kind") == COUNTS).select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")).toArrow()
    total = np.zeros(size, dtype=np.int64)
    total[summed["pair"].to_numpy()] = summed["n"].to_numpy()
    return total


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum, pairs): every text's tokens of both,
    its groups and links, the links whose pair is its B id's most frequent, and the sum of its links' pair counts.
    `pairs` has the links in order as array<struct<a, b>>."""
    small_batches(docs.sparkSession)
    made = settle(_aligned(docs, a_path, b_path, id_col, text_col), "aligned")
    own = aligner(a_path, b_path)
    count = _pair_counts(made, len(own.keys))
    a, b = np.divmod(own.keys, len(own.b_bytes))
    highest = np.zeros(len(own.b_bytes), dtype=np.int64)
    np.maximum.at(highest, b, count)
    table = docs.sparkSession.sparkContext.broadcast((count, count == highest[b], a.astype(np.int32), b.astype(np.int32)))

    def run(batches):
        count, best, a, b = table.value
        for batch in batches:
            links = batch.column("links")
            cuts = np.frombuffer(links.buffers()[1], dtype=np.int32)[links.offset:links.offset + len(links) + 1]
            data = links.buffers()[2]
            pairs = np.frombuffer(data if data is not None else b"", dtype="<u4")[cuts[0] // 4:cuts[-1] // 4]
            cuts = (cuts - cuts[0]) // 4
            sums, bests = (np.concatenate(([0], np.cumsum(of_pair[pairs], dtype=np.int64))) for of_pair in (count, best))
            listed = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(
                [pa.array(a[pairs]), pa.array(b[pairs])], ["a", "b"]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in COLUMNS), pa.array(bests[cuts[1:]] - bests[cuts[:-1]]),
                 pa.array(sums[cuts[1:]] - sums[cuts[:-1]]), listed], [*COLUMNS, "n_best", "count_sum", "pairs"])

    id_type = made.schema["doc_id"].dataType.simpleString()
    return made.where(F.col("kind") == ROWS).select(*COLUMNS, "links").mapInArrow(
        run, f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, "
             "count_sum long, pairs array<struct<a: int, b: int>>")
