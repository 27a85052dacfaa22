"""Words of a whole Arrow column of texts at once, without a Python object per word.

A word is a maximal run of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. UTF-8
writes a character beyond ASCII in bytes that are all beyond ASCII, so bytes decide.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

_BYTES = np.arange(256)
_LETTER = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
# Each byte as it stands in a word; 0 for the bytes that separate words.
LOWERED = np.where(_LETTER, _BYTES, np.where(_UPPER, _BYTES + 32, 0)).astype(np.uint8)
BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Words(NamedTuple):
    """The words' bytes one after another, where each begins (and the end), and each text's first word (and the end)."""

    data: np.ndarray
    offsets: np.ndarray
    firsts: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.firsts)

    def owners(self) -> np.ndarray:
        """The text that each word is of."""
        return np.repeat(np.arange(len(self.firsts) - 1), self.counts)

    def array(self) -> pa.LargeBinaryArray:
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.offsets) - 1, [None, pa.py_buffer(self.offsets), pa.py_buffer(self.data)])


def words_of(column: pa.Array | pa.ChunkedArray) -> Words:
    """The words of each text; a null text has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    edges = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    raw = np.frombuffer(raw if raw is not None else b"", dtype=np.uint8)[edges[0]:edges[-1]]
    edges = edges - edges[0]
    lowered = LOWERED[raw]
    inside = lowered != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = edges[:-1][edges[:-1] < len(raw)]
    begins[heads] = inside[heads]
    places = np.flatnonzero(begins)
    data = lowered[inside]
    offsets = np.append(np.cumsum(inside, dtype=np.int64)[places] - 1, len(data))
    return Words(data, offsets, np.searchsorted(places, edges))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def word_hashes(words: Words) -> np.ndarray:
    """64 bits of each word: differences of prefix sums of a polynomial in its bytes."""
    if len(words.offsets) < 2:
        return np.empty(0, dtype=np.uint64)
    powers = np.cumprod(np.full(len(words.data), BASE))
    sums = np.zeros(len(words.data) + 1, dtype=np.uint64)
    np.cumsum(powers * words.data, out=sums[1:])
    starts = words.offsets[:-1]
    back = np.cumprod(np.full(len(words.data), _INVERSE))
    return mixed((sums[words.offsets[1:]] - sums[starts]) * back[starts])


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """64 bits of every run of `size` words, in order; none if there are fewer words."""
    count = len(hashes) - size + 1
    if count < 1:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for at in range(size):
        total = total * BASE + hashes[at:at + count]
    return mixed(total)
