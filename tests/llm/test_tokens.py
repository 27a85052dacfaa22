"""Ids against the tokenizers' own libraries on texts full of white space, on long words, and piece by piece."""

import base64
import os
import random
import subprocess
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tradewind.llm import bpe, packing
from tradewind.llm.textcuts import coded_pieces

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
PROGRAM = """
import random, sys
import pyarrow as pa
from tokenizers import Tokenizer
from tradewind.llm import packing
rng = random.Random(7)
words = "green dog brown over river the bank jumps , . ... ,, a.b x1,2 \\x1c \\x85 it's \\t ! ?! 中文 é".split(" ")
plain = Tokenizer.from_file(sys.argv[1])
plain.encode_special_tokens = True
def text():
    return "".join(rng.choice(words) + rng.choice(["", " ", " ", " ", "\\n", "\\n\\n", "  ", " \\n", "\\n ", "\\t"])
                   for _ in range(rng.randint(0, 8)))
texts = [text() for _ in range(10000)]
wrong = 0
for at in range(0, len(texts), 3):
    if at % 300 == 0:
        own = packing.Tokens(sys.argv[1])
    group = texts[at:at + 3]
    for found, want in zip(own.encode(pa.array(group)), plain.encode_batch(group, add_special_tokens=False)):
        wrong += found.tolist() != want.ids
print(wrong)
"""


@pytest.mark.parametrize("seed", ["0", "1", "2"])
def test_packing_ids_are_those_of_the_library(seed):
    """In groups of three, whatever order a set of pieces has."""
    run = subprocess.run([sys.executable, "-c", PROGRAM, JSON], env=os.environ | {"PYTHONHASHSEED": seed}, text=True,
                         capture_output=True, timeout=600, check=True)
    assert run.stdout.strip() == "0"


def test_pieces_give_back_their_texts():
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a", "b1", " ", "\n", ",", ".", "\0", "\t", "é", "\x1c"], k=rng.randint(0, 12))) for _ in range(2000)]
    found, numbers, firsts = coded_pieces(pa.array([*texts, None]))
    again = ["".join(found[n] for n in numbers[a:b]) for a, b in zip(firsts[:-1], firsts[1:])]
    assert again == [*texts, ""]


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("text", [
    "x" * 1_000_000, base64.b64encode(np.random.default_rng(1).bytes(750_000)).decode().replace("+", "a").replace("/", "b"),
    "".join(chr(c) for c in np.random.default_rng(2).integers(0x4E00, 0x9FFF, 330_000))], ids=["letter", "base64", "han"])
def test_a_word_of_a_million_bytes(text):
    coder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    coder.learn([text])
    count, listed, data = coder.encode(text)
    assert data == text.encode() and [int(i) for i in listed.split()] == library().encode_ordinary(text) and count == listed.count(" ")
    coder.forget()
    assert text not in coder.known


def test_long_and_short_words_of_one_replay():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeé", k=rng.choice([1, 5, 40, 511, 513, 2000]))).encode() for _ in range(200)] + [b""]
    coder, vocab = library(), bpe.vocabulary(RANKS)
    for word, ids in zip(words, bpe.replay(words, vocab), strict=True):
        assert ids.tolist() == (coder._core_bpe.encode_single_piece(word) if word else [])


def test_packing_tokens_of_a_batch():
    coder = packing.Tokens(JSON)
    assert [x.tolist() for x in coder.encode(pa.array([None, "", "a"]))] == [[], [], coder.tokenizer.encode("a").ids]
    assert coder.encode(pa.array([], pa.string())) == [] or not len(coder.encode(pa.array([], pa.string()))[0])
    long = "y" * 5000
    coder.encode(pa.array([long]))
    assert long not in coder.known
