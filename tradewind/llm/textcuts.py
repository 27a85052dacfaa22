"""Cutting texts where no token of the byte-level patterns can cross, so that repeated pieces are encoded once.

Tokens contain white space only at their start (one space) or alone, so a text falls apart in front of every
run of white space. A regular text has only single spaces and line breaks between words, and splitting it is a
matter of replacing and splitting; any other takes the pattern.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# White space in front of a space or line break, or the mark itself: the text is not regular. (The characters
# 28 to 31, white space to this module alone, only send a text the slower way.)
IRREGULAR = re.compile(r"\s[ \n]|\0")
PIECE = regex.compile(r"\s*\S+|\s+")


def pieces(text: str) -> list[str]:
    if IRREGULAR.search(text):
        return PIECE.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


# As above, and a comma or full stop behind anything but a letter or number: elsewhere the pattern has a boundary there.
IRREGULAR_COLUMN = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}][ \n]|\x00|[^\p{L}\p{N}][.,]"

# The bytes that a piece of a regular text begins with, where it is not the first.
IN_FRONT = np.isin(np.arange(256), list(b" \n,."))


def coded_pieces(column: pa.Array, irregular: str = IRREGULAR_COLUMN,
                 cut_irregular=PIECE.findall) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different pieces of a column of texts, the pieces of all texts as numbers of those, and each text's first
    piece (and the end). Regular texts are also cut in front of commas and full stops, which leaves fewer different
    pieces; those that match `irregular` are cut by `cut_irregular`. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    odd = pc.match_substring_regex(column, irregular).to_numpy(zero_copy_only=False)
    regular = pc.if_else(pa.array(odd), "", column) if odd.any() else column
    edges = np.frombuffer(regular.buffers()[1], dtype=np.int64)[regular.offset:regular.offset + len(regular) + 1]
    data = regular.buffers()[2] if edges[-1] else pa.py_buffer(b"")
    begins = IN_FRONT[np.frombuffer(data, dtype=np.uint8)[edges[0]:edges[-1]]]
    begins[(edges[:-1] - edges[0])[np.diff(edges) > 0]] = True
    starts = np.flatnonzero(begins) + edges[0]
    firsts = np.searchsorted(starts, edges)
    places = pa.py_buffer(np.append(starts, edges[-1]))
    coded = pa.LargeStringArray.from_buffers(len(starts), places, data).dictionary_encode()
    found, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    if odd.any():
        sizes = np.diff(firsts)
        known = {piece: n for n, piece in enumerate(found)}
        parts, last = [], 0
        for n in np.flatnonzero(odd).tolist():
            own = [known.setdefault(piece, len(known)) for piece in cut_irregular(column[n].as_py())]
            parts += [numbers[last:firsts[n]], np.array(own, dtype=np.int64)]
            last, sizes[n] = firsts[n], len(own)
        numbers, found = np.concatenate([*parts, numbers[last:]]), list(known)
        firsts = np.concatenate(([0], np.cumsum(sizes)))
    return found, numbers, firsts
