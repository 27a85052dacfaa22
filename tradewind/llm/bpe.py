"""Byte-level BPE by corpus-level merge replay.

All distinct words of a stretch of the corpus lie one after another as byte tokens. An inverted index keeps, for
each merge, the positions of the token pairs that make it. Merges are replayed in rank order: the lowest rank
that any pair has is applied at all its positions at once, and only the two neighbours of each are looked up
again. In a word with several positions of one rank the leftmost goes first and the rest wait, as a merge may
bring up a lower rank beside it; so each word's merges happen in the very order of a word-by-word encoder. That takes a step
for each such position, so a word of over LONG_WORD bytes (a run without spaces, encoded data) is replayed by itself with
a heap of (rank, position), in steps that hardly grow with its length.

A task replays the distinct words of its own rows, 32 MB of text at a time, and remembers a bounded number of
pieces; no shuffle is needed. Words are the matches of the pattern, each encoded separately.

Defined results: a null text is empty; an empty text has no ids; special tokens are ordinary text; equal rows are
all returned.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tradewind.llm.common import small_batches
from tradewind.llm.textcuts import pieces

NO_RANK = np.iinfo(np.int32).max
# Characters whose words are replayed together, pieces that a worker remembers, and the longest of them.
TEXT_AT_ONCE = 16 << 20
REMEMBERED, REMEMBERED_CHARS = 500_000, 256
LONG_WORD = 512


class Vocabulary:
    """Tokens by rank, and the rank that each pair of tokens merges to."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.size = max(ranks.values()) + 1
        self.tokens = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([ranks[bytes([byte])] for byte in range(256)], dtype=np.int32)
        pairs = [(left * self.size + right, rank) for token, rank in ranks.items() for cut in range(1, len(token))
                 if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None]
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_ranks = table[:, 0].copy(), table[:, 1].astype(np.int32)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; NO_RANK where it does not merge."""
        if not len(self.pair_keys):
            return np.full(len(left), NO_RANK, dtype=np.int32)
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_RANK)


    @functools.cached_property
    def pairs(self) -> dict[int, int]:
        """The rank by key of the pair."""
        return dict(zip(self.pair_keys.tolist(), self.pair_ranks.tolist(), strict=True))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def replay_long(word: bytes, vocab: Vocabulary) -> np.ndarray:
    """Token ids of one word: the lowest rank first, of equal ones the leftmost."""
    count, size, pairs = len(word), vocab.size, vocab.pairs
    ids = vocab.byte_ids[np.frombuffer(word, dtype=np.uint8)]
    ranks = vocab.rank(ids[:-1], ids[1:]).astype(np.int64)
    places = np.flatnonzero(ranks != NO_RANK)
    waiting = (ranks[places] * count + places).tolist()
    heapq.heapify(waiting)
    token, rank = ids.tolist(), [*ranks.tolist(), NO_RANK]
    after, before = [*range(1, count), -1], list(range(-1, count - 1))

    def pair_up(left: int, right: int) -> None:
        found = pairs.get(token[left] * size + token[right], NO_RANK)
        rank[left] = found
        if found != NO_RANK:
            heapq.heappush(waiting, found * count + left)

    while waiting:
        value, place = divmod(heapq.heappop(waiting), count)
        if rank[place] != value:
            continue
        gone = after[place]
        token[place], token[gone] = value, -1
        rank[place] = rank[gone] = NO_RANK
        right, left = after[gone], before[place]
        after[place] = right
        if right >= 0:
            before[right] = place
            pair_up(place, right)
        if left >= 0:
            pair_up(left, place)
    return np.array([i for i in token if i >= 0], dtype=np.int32)


def replay(words: list[bytes], vocab: Vocabulary) -> list[np.ndarray]:
    """Token ids of each word."""
    long = {n: replay_long(word, vocab) for n, word in enumerate(words) if len(word) > LONG_WORD}
    if long:
        others = iter(replay([word for word in words if len(word) <= LONG_WORD], vocab))
        return [long[n] if n in long else next(others) for n in range(len(words))]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    count = len(data)
    if not count:
        return [np.empty(0, dtype=np.int32)] * len(words)
    token = vocab.byte_ids[data]
    word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    after = np.arange(1, count + 1, dtype=np.int32)
    before = np.arange(-1, count - 1, dtype=np.int32)
    after[np.cumsum(lengths[lengths > 0]) - 1] = -1
    before[np.concatenate(([0], np.cumsum(lengths[lengths > 0])[:-1]))] = -1
    alive = np.ones(count, dtype=bool)
    rank = np.full(count, NO_RANK, dtype=np.int32)
    inner = np.flatnonzero(after >= 0)
    rank[inner] = vocab.rank(token[inner], token[after[inner]])

    index: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def post(places: np.ndarray) -> None:
        """Add positions to the index under their pair's rank."""
        own = rank[places]
        places = places[own != NO_RANK]
        if not len(places):
            return
        order = np.argsort(rank[places], kind="stable")
        places = places[order]
        own = rank[places]
        cuts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))).tolist()
        for a, b in zip(cuts, [*cuts[1:], len(places)], strict=True):
            value = int(own[a])
            if value not in index:
                index[value] = []
                heapq.heappush(ranks, value)
            index[value].append(places[a:b])

    post(inner)
    while ranks:
        value = heapq.heappop(ranks)
        posted = index.pop(value)
        places = np.unique(np.concatenate(posted)) if len(posted) > 1 else posted[0]
        places = places[alive[places] & (rank[places] == value)]
        if not len(places):
            continue
        if len(posted) == 1:
            places = np.sort(places)
        owner = word[places]
        first = np.concatenate(([True], owner[1:] != owner[:-1]))
        waiting = places[~first]
        places = places[first]
        gone = after[places]
        token[places] = value
        alive[gone] = False
        rank[gone] = NO_RANK
        right = after[gone]
        after[places] = right
        has_right = right >= 0
        before[right[has_right]] = places[has_right]
        rank[places] = NO_RANK
        left_of = places[has_right]
        rank[left_of] = vocab.rank(token[left_of], token[right[has_right]])
        left = before[places]
        left = left[left >= 0]
        rank[left] = vocab.rank(token[left], token[after[left]])
        post(np.concatenate([left_of, left, waiting]))

    ends = np.cumsum(np.bincount(word[alive], minlength=len(words)))
    return np.split(token[alive], ends[:-1])


class Encoder:
    """Encodes and decodes texts, remembering the pieces it has met."""

    def __init__(self, path: str, pattern: str):
        self.vocab, self.pattern = vocabulary(path), regex.compile(pattern)
        self.known: dict[str, tuple[int, str, bytes]] = {}
        self.long: list[str] = []

    def learn(self, found: list[str]) -> None:
        """Replay the pieces of these texts that are not known."""
        new: set[str] = set()
        for text in found:
            new.update(pieces(text))
        if len(self.known) > REMEMBERED:
            self.known = {piece: self.known[piece] for piece in new if piece in self.known}
        new.difference_update(self.known)
        order = list(new)
        split = [self.pattern.findall(piece) for piece in order]
        words = list({word for own in split for word in own})
        ids = dict(zip(words, replay([word.encode() for word in words], self.vocab), strict=True))
        tokens = self.vocab.tokens
        for piece, own in zip(order, split, strict=True):
            listed = [i for word in own for i in ids[word].tolist()]
            self.known[piece] = (len(listed), "".join([f" {i}" for i in listed]),
                                 b"".join([tokens[i] for i in listed]))
        self.long = [piece for piece in order if len(piece) > REMEMBERED_CHARS]

    def forget(self) -> None:
        """Let go of the long pieces."""
        for piece in self.long:
            self.known.pop(piece, None)
        self.long = []

    def encode(self, text: str) -> tuple[int, str, bytes]:
        """Number of ids, the ids as text with a space before each, and the bytes that they decode to."""
        known = self.known
        found = [known[piece] for piece in pieces(text)]
        if not found:
            return 0, "", b""
        counts, listed, data = zip(*found, strict=True)
        return sum(counts), "".join(listed), b"".join(data)


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode_decode(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                  digests: bool = False) -> DataFrame:
    """(id, n_tokens, ids array<int>, decoded binary) of every whole text.

    With `digests`, (id, n_tokens, ids_sha256, decoded_sha256): SHA-256 of the ids in decimal joined by spaces,
    and of the decoded bytes, made in the same task so that neither travels.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    id_kind = to_arrow_type(docs.schema[id_col].dataType)
    names = ["id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
    kinds = [pa.string(), pa.string()] if digests else [pa.list_(pa.int32()), pa.binary()]
    schema = f"id {id_type}, n_tokens long, " + (
        "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary")

    def rows(ids: list, found: list[str]) -> pa.RecordBatch:
        coder = encoder(vocabulary_path, pattern)
        coder.learn(found)
        counts, left, right = [], [], []
        for text in found:
            count, listed, data = coder.encode(text)
            counts.append(count)
            if digests:
                left.append(hashlib.sha256(listed[1:].encode()).hexdigest())
                right.append(hashlib.sha256(data).hexdigest())
            else:
                left.append(np.array(listed.split(), dtype=np.int32))
                right.append(data)
        coder.forget()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, id_kind), pa.array(counts, pa.int64()), pa.array(left, kinds[0]), pa.array(right, kinds[1])],
            names)

    def run(batches):
        ids, found, size = [], [], 0
        for batch in batches:
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(own)
                found.append(text or "")
                size += len(found[-1])
                if size >= TEXT_AT_ONCE:
                    yield rows(ids, found)
                    ids, found, size = [], [], 0
        if ids:
            yield rows(ids, found)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
