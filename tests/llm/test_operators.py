"""Every operator against a brute-force version, with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from tradewind.llm import bpe, chat, langid, neighbours, packing, quality, sharding, simhash, toxicity, url_filter
from tradewind.llm.components import components
from tradewind.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `key` long, node string, row string, count int"
BASE = "the and of water over green hill with old stone bridge near quiet river under bright moon"
EDGES = [None, "", " \t\n", "one", "Two  words\u00a0\u2003here\n\n tail ", "A b c d e f", "a B c d e f", "<|endoftext|> it's <|x|>\0 end",
         "na\u00efve \u00c9l\u00e8ve \U0001f600 \u4e2d\u6587 123 4567 " * 3, "same same same same " * 20, BASE, BASE, BASE.upper(),
         " ".join(f"w{i}" for i in range(9000)), "x" * 40000, "line a\nline a\n\nline b 1\nLINE B 2\n"]


def rows(texts, start=0):
    return [(start + i, text, ("en", "fr", None)[i % 3], None if i % 5 == 0 else f"s{i % 2}", 0, 1, "n", "r", 2)
            for i, text in enumerate(texts)]


@pytest.fixture(scope="module")
def edge(spark):
    made = rows(EDGES)
    made += [made[10], made[1], (None, "no id at all", "en", "s1", 0, 1, "n", "r", 2)]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def fingerprint(text, words=4):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i:i + words]).encode(), 42) for i in range(max(1, len(found) - words + 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def classes(prints):
    """The smallest id that each id reaches by links of at most 4 bits."""
    parent = {i: i for i, _ in prints}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in prints:
        for j, b in prints:
            if (a ^ b).bit_count() <= 4 and find(i) != find(j):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: find(i) for i in parent}


def test_simhash_groups_match_brute_force(spark, edge, empty):
    got = simhash.simhash_groups(edge).collect()
    assert len(got) == edge.count()
    text = {r["doc_id"]: r["text"] for r in edge.collect()}
    prints = {i: fingerprint(t) for i, t in text.items()}
    assert all(r["print"] % (1 << 64) == prints[r["id"]] for r in got)
    known = classes([(i, p) for i, p in prints.items() if i is not None])
    assert all(r["component"] == known[r["id"]] for r in got if r["id"] is not None)
    assert simhash.simhash_groups(empty).count() == 0


def test_links_connect_what_lies_within_four_bits(spark):
    """Clusters around centers, one of them large enough to need tiles."""
    rng = np.random.default_rng(5)
    prints = set(rng.integers(0, 1 << 63, 300).tolist())
    center = int(rng.integers(0, 1 << 63))
    while len(prints) < 1500:
        flips = rng.choice(64, rng.integers(0, 7), replace=False)
        prints.add((center ^ sum(1 << int(b) for b in flips)) % (1 << 63))
    order = sorted(prints)
    frame = spark.createDataFrame([(i, p, 0) for i, p in enumerate(order)], "node long, print long, family int")
    found = {(r["a"], r["b"]) for r in simhash.links(frame, "test", block_rows=64).collect()}
    assert all((order[a] ^ order[b]).bit_count() <= 4 and a < b for a, b in found)
    parent = list(range(len(order)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in found:
        parent[find(a)] = find(b)
    values = np.array(order, dtype=np.uint64)
    for i in range(len(order)):
        assert {find(int(j)) for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 4)} == {find(i)}


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    found = components(spark.createDataFrame(path + star + [(7, 7)], "a long, b long"), "test").collect()
    assert {r["node"]: r["root"] for r in found} == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_near_duplicates_are_found_by_fingerprint_chains(spark, monkeypatch):
    """With bands that nothing shares, the chains' links alone give the copies whose fingerprints lie within 4 bits."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    docs = []
    for i in range(0, 40, 2):
        text = rng.choices(words, k=400)
        docs += [(i, " ".join(text)), (i + 1, " ".join([*text, "x"]))]
    prints = [simhash.sketch(text.encode())[0] & (1 << 64) - 1 for _, text in docs]
    linked = sum((prints[i] ^ prints[i + 1]).bit_count() <= 4 for i in range(0, 40, 2))
    assert linked >= 15
    monkeypatch.setattr(simhash, "_band_pairs", lambda batches: (simhash._long_columns([]) for _ in batches))
    kept = simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert kept.count() == 40 - linked


def test_near_duplicates_keep_one_of_each_group(spark, empty):
    words = [f"word{i}" for i in range(300)]
    near = words.copy()
    near[150] = "other"
    far = [f"other{i}" if i % 6 == 0 else w for i, w in enumerate(words)]
    docs = spark.createDataFrame(rows([" ".join(w) for w in (words, near, far, words)] + ["", None]) + rows(["dup", "dup"])[:1]
                                 + [(9, "again", "en", "s", 0, 1, "n", "r", 2)] * 2, SCHEMA)
    kept = simhash.near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["text"][:12] for r in kept.collect()) == ["", "again", "dup", "other0 word1", "word0 word1 "]
    assert simhash.near_duplicates(empty).count() == 0


def edited(kind, similarity, rng, words=100):
    """A text and its copy with scattered words changed or a passage more, at just the similarity or above it."""
    text = [f"w{i}" for i in rng.zipf(1.3, words) % 5000]
    copy = text.copy()
    for at in rng.permutation(words).tolist() if kind == "scattered" else range(words):
        last = copy.copy()
        if kind == "scattered":
            copy[at] = f"n{rng.integers(1 << 40)}"
        else:
            copy.append(f"n{rng.integers(1 << 40)}")
        if jaccard(text, copy) < similarity:
            return " ".join(text), " ".join(last)


def jaccard(one, other):
    one, other = ({tuple(x[i:i + 5]) for i in range(max(1, len(x) - 4))} for x in (one, other))
    return len(one & other) / len(one | other)


@pytest.mark.parametrize("kind", ["scattered", "block"])
def test_near_duplicates_of_either_kind_of_edit_are_found(spark, kind):
    rng = np.random.default_rng(6)
    texts = [text for similarity in (0.8, 0.85, 0.9) for _ in range(60) for text in edited(kind, similarity, rng)]
    assert simhash.near_duplicates(spark.createDataFrame(rows(texts), SCHEMA)).count() == len(texts) // 2


@pytest.mark.parametrize("open_rows", [1024, 64])
def test_near_duplicates_of_one_text_that_are_not_near_each_other(spark, monkeypatch, open_rows):
    """Only the original connects its many variants."""
    monkeypatch.setattr(simhash, "OPEN_ROWS", open_rows)
    original = [f"word{i}" for i in range(100)]
    rng, texts = np.random.default_rng(7), [original]
    for d in range(800):
        copy = original.copy()
        for at in (rng.integers(4, 45), rng.integers(55, 96)):
            copy[at] = f"v{d}"
        texts.append(copy)
    assert all(jaccard(original, x) >= 0.8 for x in texts) and sum(jaccard(texts[1], x) < 0.8 for x in texts) > 700
    alone = [[f"a{d}x{i}" if i % 9 == d % 9 else w for i, w in enumerate(original)] for d in range(40)]
    assert all(jaccard(x, y) < 0.8 for x in alone for y in texts + alone if x is not y)
    docs = spark.createDataFrame(rows([" ".join(x) for x in texts + alone]), SCHEMA)
    assert sorted(r["doc_id"] for r in simhash.near_duplicates(docs).collect()) == [0, *range(801, 841)]


def test_toxicity_learns_marking_words(spark, edge, empty):
    rng = np.random.default_rng(1)
    syllables = ["ba", "ko", "ri", "tu", "ne", "sa", "lo", "mi"]
    texts, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(80)]
        if i % 4 == 0:
            for at in rng.integers(0, 80, 5):
                words[at] = rng.choice(["vermin", "wretched", "dimwit"])
        texts.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    marks = spark.createDataFrame(labels[:500] + labels[:5] + [(None, 1)], "doc_id long, label int")
    model = toxicity.fit(docs, marks)
    got = toxicity.toxicity(docs.where("doc_id >= 500"), model, ["doc_id"]).collect()
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in got]) >= 0.95
    scored = toxicity.toxicity(edge, model, ["doc_id", "key"]).collect()
    assert len(scored) == edge.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.toxicity(empty, model, ["doc_id"]).count() == 0
    assert toxicity.fit(docs, marks.where("label = 0")) is None
    assert {r["score"] for r in toxicity.toxicity(edge, None, ["doc_id"]).collect()} == {0.0}


def test_toxicity_learns_beginnings(spark):
    """Marks that never come up as the same word twice: only their beginning is shared."""
    rng = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    texts, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(["ba", "ko", "ri", "tu", "ne", "sa"], rng.integers(1, 4))) for _ in range(60)]
        if i % 4 == 0:
            for at in rng.integers(0, 60, 4):
                words[at] = "\u00e9vejx" + "".join(rng.choice(letters, 5))
        texts.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels[:450], "doc_id long, label int"))
    got = toxicity.toxicity(docs.where("doc_id >= 450"), model, ["doc_id"]).collect()
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in got]) >= 0.95


def test_shards_are_contiguous_and_near_equal(spark, edge, empty):
    got = sharding.byte_shards(edge, 4).orderBy("shard", "slot").collect()
    texts = {r["doc_id"]: r["text"] for r in edge.collect()}
    assert len(got) == edge.count()
    assert all(r["size"] == len((texts[r["id"]] or "").encode()) + 1 for r in got)
    assert all(r["text_crc32"] == zlib.crc32((texts[r["id"]] or "").encode()) for r in got)
    ids = [-1 if r["id"] is None else r["id"] for r in got]
    assert ids == sorted(ids)
    for shard in {r["shard"] for r in got}:
        assert [r["slot"] for r in got if r["shard"] == shard] == list(range(sum(r["shard"] == shard for r in got)))
    total, before = sum(r["size"] for r in got), 0
    for r in got:
        assert r["shard"] == min(3, (2 * before + r["size"]) * 4 // (2 * total))
        before += r["size"]
    assert sharding.byte_shards(empty, 4).count() == 0


def test_language_matches_the_formula(spark, edge, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where("doc_id % 5 <> 0"))
    got = langid.languages(docs, model, ["doc_id", "lang"]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got if r["doc_id"] % 5 == 0]) >= 0.95
    text = "\u00c9t\u00e9 42 the"
    codes = " \u00e9t\u00e9 the "
    logs = model.log_prior.copy()
    for order in langid.ORDERS:
        for i in range(len(codes) - order + 1):
            gram = np.array([ord(c) for c in codes[i:i + order]], dtype=np.uint32)
            logs = logs + model.log_likelihood[langid.buckets(gram, order)[0]]
    assert np.allclose(langid.log_scores([langid.letters(text)], model)[0], logs)
    found = {r["doc_id"]: r for r in langid.languages(edge, model, ["doc_id"]).collect()}
    assert [found[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and found[0]["score"] == 0
    kept = langid.languages(edge, model, edge.columns, accept=0.5)
    assert kept.columns == edge.columns and kept.count() < edge.count()
    assert langid.languages(empty, None, ["doc_id"]).count() == 0 and langid.fit(empty) is None
    assert {r["lang_pred"] for r in langid.languages(edge, None, ["doc_id"]).collect()} == {"und"}


def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(400, 12)).astype(np.float32)
    vectors[50:120] = vectors[50]
    made = [(i, v.tolist()) for i, v in enumerate(vectors)]
    made += [(900, None), (901, [0.0] * 12), (902, [float("nan")] * 12), (903, [None] + [1.0] * 11), (904, [1.0, 2.0]),
             (None, [1.0] * 12), (905, []), (60, [5.0] * 12)]
    frame = spark.createDataFrame(made, "vec_id long, embedding array<float>").repartition(4)
    got = defaultdict(list)
    for r in neighbours.nearest(frame, frame.where("vec_id % 20 = 0"), 7).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    valid = [(i, np.array(v, dtype=float)) for i, v in made
             if i is not None and v is not None and None not in v and len(v) == 12 and np.isfinite(v).all() and any(v)]
    for query, q in valid[:400]:
        if query % 20 == 0 and query != 60:
            want = sorted(((-float((q * v).sum()), i) for i, v in valid if i != query))[:7]
            assert [i for _, i in want] == [i for i, _ in got[query]]
            assert np.allclose([-s for s, _ in want], [s for _, s in got[query]], rtol=1e-12)
    assert 900 not in got and 901 not in got
    assert neighbours.nearest(frame.limit(0), frame.limit(0), 7).count() == 0


def test_neighbours_of_repeated_rows(spark):
    """Queries given twice, with one vector and with two, and ids given often with a hot vector."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(300, 8)).astype(np.float32).astype(float)
    vectors[40:140] = vectors[40]
    made = [(i, v.tolist()) for i, v in enumerate(vectors)]
    made += [(20, vectors[20].tolist()), (40, vectors[40].tolist()), (60, vectors[7].tolist())] + [(100, vectors[40].tolist())] * 9
    made += [(40, vectors[40].tolist())] * 12
    frame = spark.createDataFrame(made, "vec_id long, embedding array<double>")
    for parts in (1, 4):
        dealt = frame.coalesce(1) if parts == 1 else frame.repartition(parts)
        got = defaultdict(list)
        for r in neighbours.nearest(dealt, dealt.where("vec_id % 20 = 0"), 7).orderBy("query_id", "rank").collect():
            got[r["query_id"]].append((r["vec_id"], r["score"]))
        for query in range(0, 300, 20):
            own = [np.array(v) for i, v in made if i == query]
            want = sorted((-max(float(np.dot(q, v)) for q in own), i) for i, v in made if i != query)[:7]
            assert np.allclose([-s for s, _ in want], [s for _, s in got[query]], rtol=1e-9)
            assert [i for _, i in want] == [i for i, _ in got[query]] or len({round(s, 9) for s, _ in want}) < 7
            if query in (100, 120):
                assert [i for i, _ in got[query]] == [i for _, i in want]


def test_url_rules_and_reputation(spark):
    rules = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"))
    urls = [("http://WWW.Example.com/en/1?x", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
            ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
            ("x://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), ("http://b.com", "b.com", "", None, "allow"),
            (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("http://bad.org/#a", "bad.org", "/", None, "block"),
            ("http://good.org/", "good.org", "/", None, "allow"), ("http://bad.org/#a", "bad.org", "/", None, "block")]
    pages = spark.createDataFrame([(i, u[0], "h") for i, u in enumerate(urls)], "page_id int, url string, lower string")
    outcomes = spark.createDataFrame([("http://bad.org/1", 1)] * 40 + [("http://good.org/", 0)] * 40 + [(None, None)],
                                     "url string, bad int")
    got = url_filter.judge(pages, outcomes, rules).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == [u[1:] for u in urls]
    none = url_filter.judge(pages.limit(0), outcomes.limit(0), rules)
    assert none.count() == 0


def test_chat_layouts_round_trip(spark):
    hard = "<|im_end|>\n<|im_start|>assistant <\\| <\\\\ << \u00e9"
    records = spark.createDataFrame([
        (1, '{"prompt": "p", "response": "r"}'), (2, '{"instruction": "i", "input": "n", "output": "o"}'),
        (3, '{"messages": [{"role": "a\\nb<|", "content": null}, {"role": "assistant", "content": ""}]}'),
        (4, '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "tool", "value": "t"}]}'),
        (5, '{"prompt": "p", "messages": []}'), (6, "broken"), (7, None), (8, '{"messages": []}')],
        "id int, json string").selectExpr("id", f"from_json(json, '{chat.RECORD}') AS record")
    records = records.unionByName(spark.range(1).selectExpr(
        "9 AS id", f"from_json(to_json(named_struct('prompt', '{hard.replace(chr(92), chr(92) * 2)}', 'response', "
        f"'{hard.replace(chr(92), chr(92) * 2)}')), '{chat.RECORD}') AS record"))
    turns = chat.canonical(records, "record")
    layouts = {r["id"]: (r["layout"], None if r["turns"] is None else [tuple(t) for t in r["turns"]]) for r in turns.collect()}
    assert layouts[1] == ("prompt", [("user", "p"), ("assistant", "r")])
    assert layouts[2] == ("instruction", [("user", "i\nn"), ("assistant", "o")])
    assert layouts[3] == ("messages", [("a\nb<|", ""), ("assistant", "")])
    assert layouts[4] == ("conversations", [("user", "q"), ("assistant", "a"), ("tool", "t")])
    assert layouts[5] == layouts[6] == layouts[7] == (None, None) and layouts[8] == ("messages", [])
    formatted = chat.format_turns(turns, "id")
    read = formatted.select("id", chat.read_turns(formatted["formatted"]).alias("turns"),
                            chat.read_loss(formatted["formatted"], formatted["loss_spans"]).alias("loss"))
    assert {r["id"] for r in formatted.where("formatted IS NULL").collect()} == {5, 6, 7}
    for r in read.where("turns IS NOT NULL").collect():
        want = layouts[r["id"]][1]
        assert [tuple(t) for t in r["turns"]] == want
        assert r["loss"] == [text for role, text in want if role == "assistant" and text]


def test_bpe_matches_the_library_and_decodes(spark, edge, empty):
    import public_tokenizers as public
    import tiktoken

    path = public.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = bpe.encode_decode(edge, path, public.PATTERN)
    for r in coded.join(edge, edge["doc_id"].eqNullSafe(coded["id"])).collect():
        assert list(r["ids"]) == library.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids"])
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    digests = bpe.encode_decode(edge.where("doc_id = 4"), path, public.PATTERN, digests=True).first()
    ids = library.encode_ordinary(EDGES[4])
    assert digests["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encode_decode(empty, path, public.PATTERN).count() == 0
    rng = np.random.default_rng(2)
    tokens = list(ranks)
    odd = [b"".join(tokens[i] for i in rng.integers(0, len(tokens), 4)) for _ in range(3000)] + [b"a" * n for n in range(1, 60)]
    want = [library._encode_single_piece(word) for word in odd]
    assert [x.tolist() for x in bpe.replay(odd, bpe.vocabulary(path))] == want


def test_quality_measures_and_boilerplate(spark, edge, empty):
    got = {r["id"]: r for r in quality.judge(edge).collect()}
    for r in edge.collect():
        text = r["text"] or ""
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {j for i in range(len(words) - 2) if windows[words[i], words[i + 1], words[i + 2]] > 1 for j in (i, i + 1, i + 2)}
        lines = Counter(line for line in text.split("\n") if WORD.search(line))
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(lines.values()) - len(lines), len(covered))
        assert tuple(got[r["doc_id"]][name] for name in quality.MEASURES) == want
    notice = "all rights of this notice are with its makers and nobody else in the world may use it"
    # Digits do not tell lines apart, so words are made of letters.
    name = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(100)]
    body = [" ".join(f"t{name[d]}x{name[i]}" for i in range(80)) for d in range(30)]
    mine = [f"{body[d]}\n{notice}" for d in range(30)] + ["\n".join([notice] * 4 + ["few words"])]
    copies = ["\n".join(" ".join(f"c{name[k]}x{name[i]}" for i in range(20)) for k in range(5)) + f"\nend {chr(97 + d)}" for d in range(25)]
    docs = spark.createDataFrame([(i, t, "en", "host", 0, 1, "n", "r", 2) for i, t in enumerate(mine + copies)], SCHEMA)
    kept = {r["doc_id"]: r["text"] for r in quality.clean(docs).collect()}
    assert sorted(kept) == [*range(30), *range(31, 56)]
    assert all(kept[d] == body[d] for d in range(30)) and all(kept[31 + d] == copies[d] for d in range(25))
    assert quality.clean(edge).columns == edge.columns and quality.clean(empty).count() == quality.judge(empty).count() == 0


def test_packing_places_every_id_once(spark, edge, empty):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    docs = edge.where("doc_id is not null").dropDuplicates(["doc_id"])
    got = packing.pack(docs, path, window=512).collect()
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, packing.END] for r in docs.collect()}
    found, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert list(np.frombuffer(r["ids"], "<u4")) == ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and r["doc_tokens"] == len(ids[r["doc_id"]])
        found[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in [*[sorted(x) for x in found.values()], *[sorted(x) for x in sequences.values()]]:
        assert all(a[0] + a[1] == b[0] for a, b in zip(pieces, pieces[1:], strict=False)) and pieces[0][0] == 0
    assert all(sum(n for _, n in found[d]) == len(ids[d]) for d in ids)
    totals = [sum(n for _, n in x) for x in sequences.values()]
    assert sum(t < 512 for t in totals) <= 1 and max(totals) == 512
    assert packing.pack(edge, path).agg({"doc_tokens": "count"}).first()[0] >= edge.count()
    assert packing.pack(empty, path).count() == 0


def test_a_word_of_the_vocabulary_is_its_own_encoding():
    """So no pair but those of the merges can come up, and both libraries' ids agree."""
    import public_tokenizers as public

    vocab = bpe.vocabulary(public.path("byte_bpe_50k.tiktoken"))
    words = [token for token in vocab.tokens if token]
    assert all(len(ids) == 1 for ids in bpe.replay(words, vocab))


def test_queries_have_their_columns(spark):
    want = {"op3_sharding": "doc_id size text_crc32 law shard slot grown_shard", "op4_language": "doc_id held_out lang_pred score",
            "op6_url_filter": "page_id host path rule verdict",
            "op7_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars"}
    for name, columns in want.items():
        frame = QUERIES[name](spark, SF)
        assert frame.columns == columns.split() and frame.count() > 0
