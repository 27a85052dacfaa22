"""Decontamination, alignment of tokenizers and ranked search against brute force, and against SQL where it exists."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tests.compare import duck, duck_rows, spark_rows
from tradewind.llm import alignment, decontamination, lexical
from tradewind.llm.oracle import ORACLE
from tradewind.llm.queries import QUERIES
from tradewind.llm.words import words_of

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, row long, item string, `set` string, print long, kind int, links binary, n long, number int"
ITEMS = "item_id long, text string, row long, words binary, rank int, `at` int"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EDGES = [None, "", " ", "\n", "...", "One", "naïve Élève \U0001f600中文 é", "a\0b \x1f c\x85d", "tab\tand\r\nline\r\n\r\nend \n ",
         "  two  spaces   three\n\n\nlines\n", "it's we'll <|endoftext|> <s> </s> <0x0A> <unk>", "under▁score here", "trailing ",
         "x" * 30000, "中文字" * 4000, " nbsp em　wide", "; \r;\r {\r}\r", "﻿bom ​ zero � end"]


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lowered(text))


def docs_frame(spark, texts, ids=None, parts=3):
    rows = [(n, text, 1, "i", "s", 2, 3, b"x", 4, 5) for n, text in zip(ids or range(len(texts)), texts)]
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def items_frame(spark, items):
    return spark.createDataFrame([(n, text, 1, b"x", 2, 3) for n, text in items], ITEMS)


def prose(rng, size, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(size))


def test_words_of_a_column():
    column = pa.array([*EDGES, "AB", "cd"])
    found = words_of(column)
    flat = [w.decode() for w in found.array().to_pylist()]
    want = [words(text) for text in column.to_pylist()]
    assert found.counts.tolist() == [len(w) for w in want]
    assert flat == [w for own in want for w in own]
    again = words_of(column[5:9])
    assert [w.decode() for w in again.array().to_pylist()] == [w for own in want[5:9] for w in own]
    assert not words_of(pa.array([], pa.string())).counts.size


def brute_contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        own = words(text)
        size = min(10, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            windows[tuple(own[i:i + size])].add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        own = words(text)
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(own) - size + 1):
                if (span := tuple(own[i:i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[span]
        out.append((doc_id, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(12 if seed == 1 else 400)] + ["Été", "X9"]
    items = [(n, prose(rng, rng.choice([9, 10, 11, 15, 30, 60]), vocabulary)) for n in range(40)]
    items += [(7, items[3][1]), (None, items[4][1]), (100, None), (101, "..."), (102, "w1 w2"), (103, "x9"), (104, items[5][1])]
    items += items[:2]
    docs = []
    for _ in range(120):
        parts = [prose(rng, rng.randint(0, 80), vocabulary)]
        for _ in range(rng.randint(0, 3)):
            own = words(rng.choice(items)[1])
            start = rng.randint(0, max(0, len(own) - 1))
            parts += [", ".join(own[start:start + rng.randint(5, 20)]).upper(), prose(rng, rng.randint(0, 30), vocabulary)]
        docs.append("\n".join(parts))
    docs += EDGES + [docs[0], "x9 " * 3000, " ".join(words(items[5][1])[:9]), items[6][1]]
    got = decontamination.contamination(docs_frame(spark, docs), items_frame(spark, items)).collect()
    want = brute_contamination(list(enumerate(docs)), items)
    assert sorted([tuple(r[:6]) for r in got], key=repr) == want
    assert sum(r[5] for r in want) > 40
    for r in got:
        assert sum(h["stop"] - h["start"] for h in r["hits"]) == r["n_hit"]
        assert all(a["stop"] < b["start"] for a, b in zip(r["hits"], r["hits"][1:]))


def test_contamination_of_empty_tables(spark):
    docs, items = docs_frame(spark, EDGES), items_frame(spark, [(1, "one")])
    assert decontamination.contamination(docs.limit(0), items).count() == 0
    got = decontamination.contamination(docs, items.limit(0)).collect()
    assert len(got) == len(EDGES) and not any(r["contaminated"] for r in got)


def test_every_shared_span_of_ten_words_keeps_a_fingerprint():
    rng = random.Random(3)
    span = [f"s{n}" for n in range(10)]
    prints = set()
    for _ in range(50):
        around = [[f"r{rng.randrange(10**9)}" for _ in range(rng.randint(0, 12))] for _ in range(2)]
        found = decontamination.Spans(words_of(pa.array([" ".join([*around[0], *span, *around[1]])])), [10], 10, 6)
        prints.add(int(found.print[len(around[0])]))
    assert len(prints) == 1


class Brute:
    """Tokens with their bytes, from whole texts and cumulative lengths alone."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in kept]
        self.letters = {chr(b): b for b in kept} | {chr(256 + n): b for n, b in enumerate(rest)}

    def tokens(self, text):
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(f" {text}", add_special_tokens=False).ids]
        b = [(i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode())
             for i in self.b.encode(text) for p in [self.b.id_to_piece(i)]]
        return a, b

    def align(self, text):
        if not text:
            return [], [], [], []
        a, b = self.tokens(text)
        if any(b"".join(data for _, data in own) != f" {text}".encode() for own in (a, b)):
            return [], [], [], []
        ends_a, ends_b = (np.cumsum([len(data) for _, data in own]).tolist() for own in (a, b))
        cuts = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a.index(c)][0], b[ends_b.index(c)][0]) for c in cuts]
        groups, last = [], 0
        for cut in cuts:
            groups.append(",".join(str(i) for (i, _), e in zip(a, ends_a) if last < e <= cut) + "|"
                          + ",".join(str(i) for (i, _), e in zip(b, ends_b) if last < e <= cut))
            last = cut
        return a, b, groups, links


def test_alignment_matches_brute_force(spark):
    rng = random.Random(4)
    bits = ["word", "Word", " ", " ", " ", "\n", "\n\n", "\r", "\t", "été", "中", "\U0001f600", ".", ",", ";", "'s", "12", "\0", "▁", "\x1c", " ",
            "<0x41>", "</s>", "zq", "the"]
    texts = [t[:300] if t else t for t in EDGES] + ["".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(600)]
    texts += [texts[-1], texts[-2]]
    brute = Brute()
    found = [brute.align(text) for text in texts]
    count = Counter(link for _, _, _, links in found for link in links)
    highest = defaultdict(int)
    for (_, b), n in count.items():
        highest[b] = max(highest[b], n)
    got = alignment.align(docs_frame(spark, texts), A, B).collect()
    assert len(got) == len(texts)
    for r in got:
        a, b, groups, links = found[r["doc_id"]]
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"]) == (len(a), len(b), len(groups), len(links)), repr(texts[r["doc_id"]])
        assert r["groups_sha256"] == (hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
        assert [tuple(p) for p in r["pairs"]] == links
        assert r["count_sum"] == sum(count[link] for link in links)
        assert r["n_best"] == sum(count[link] == highest[link[1]] for link in links)
    assert alignment.align(docs_frame(spark, texts).limit(0), A, B).count() == 0


def test_alignment_of_long_texts(spark):
    """A long word, a long run without spaces, and many parts: whole texts, no hang."""
    texts = ["x" * 200_000, "中文字漢" * 20_000, "alpha beta\n" * 20_000]
    got = {r["doc_id"]: r for r in alignment.align(docs_frame(spark, texts), A, B).collect()}
    brute = Brute()
    for n, text in enumerate(texts):
        a, b = brute.tokens(text)
        assert (got[n]["n_a"], got[n]["n_b"]) == (len(a), len(b))


def brute_ranked(docs, items, best=20):
    terms = [(doc_id, Counter(words(text))) for doc_id, text in docs]
    terms = [(doc_id, own) for doc_id, own in terms if own]
    count, length = len(terms), sum(sum(own.values()) for _, own in terms)
    df = Counter(t for _, own in terms for t in own)
    out = []
    for item_id, text in dict.fromkeys(items):
        scored = []
        for doc_id, own in terms:
            m = 75 + 25 * sum(own.values()) * count // length
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * own[t] // (1000 * own[t] + 12 * m))
                        for t in words(text) if t in own)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, n + 1, doc_id, -score) for n, (score, _, _, doc_id) in enumerate(sorted(scored)[:best])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 24, 500])
def test_ranked_search_matches_brute_force(spark, block_bytes):
    rng = random.Random(6)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    docs = [prose(rng, rng.choice([1, 5, 40, 200]), vocabulary) for _ in range(400)] + EDGES
    docs += [docs[7]] * 60 + [f"{docs[8]} t1", " ".join(f"t{n}" for n in range(3000))]
    docs += [" ".join(f"t{n}" for n in range(1, k)) for k in range(1, 80)]
    ids = [*range(len(docs) - 3), None, 5, 6]
    items = [(n, prose(rng, rng.randint(1, 40), vocabulary)) for n in range(30)]
    items += [(50, None), (51, ""), (52, "nowhere"), (53, "t1 t1 T1"), (54, docs[7]), (None, "t2 t3"), items[0]]
    got = lexical.rank_documents(docs_frame(spark, docs, ids), items_frame(spark, items), block_bytes=block_bytes)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == brute_ranked(list(zip(ids, docs)), items)


def test_ranked_search_of_empty_tables(spark):
    docs, items = docs_frame(spark, EDGES), items_frame(spark, [(1, "one")])
    assert [tuple(r)[:3] for r in lexical.rank_documents(docs, items).collect()] == [(1, 1, 5)]
    for d, i in ((docs.limit(0), items), (docs, items.limit(0))):
        got = lexical.rank_documents(d, i)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_leave_out_documents():
    """The search does not reach most leaves once an item has its best documents."""
    rng = np.random.default_rng(1)
    bases = [rng.choice(60, 12, replace=False) for _ in range(25)]
    vectors = [np.unique(np.append(bases[n % 25], rng.integers(0, 60, 2))) for n in range(500)]
    vectors = [(terms, np.ones(len(terms), dtype=np.int64)) for terms in vectors]
    root = lexical.tree(list(range(500)), [100] * 500, vectors, 5)
    queries = lexical.Queries(np.array([0]), np.sort(bases[3]), np.full(12, 1000), np.array([0]))
    seen = []

    class Watched(lexical.Queries):
        def scores(self, values):
            seen.append(1)
            return super().scores(values)

    results = [[]]
    lexical.search(root, Watched(*queries), np.zeros(60, dtype=np.int64), results, 5)
    assert len(results[0]) == 5 and all(doc[1] % 25 == 3 for _, doc in results[0]) and len(seen) < 400


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_sql(spark, name):
    columns, got = spark_rows(QUERIES[name](spark, SF))
    want_columns, want = duck_rows(duck(SF), ORACLE[name])
    assert columns == want_columns
    assert got == want and got


def test_alignment_query(spark):
    got = QUERIES["op12_alignment"](spark, SF).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(text)
    brute = Brute()
    for r in got[:20]:
        a, b = brute.tokens(text[r["doc_id"]])
        assert (r["n_a"], r["n_b"]) == (len(a), len(b))
    assert all(r["n_links"] >= r["n_best"] for r in got)
