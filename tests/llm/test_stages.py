"""Stages of the pipeline on cases that once went wrong, the pipeline as a whole, and every query as registered."""

import base64
import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_operators import SCHEMA, SF
from tradewind.llm import chat, langid, neighbours, quality, simhash, toxicity, url_filter
from tradewind.llm.queries import QUERIES

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def word(rng, size=6):
    return "".join(rng.choice(LETTERS) for _ in range(size))


def prose(rng, count):
    return " ".join(word(rng) for _ in range(count))


@pytest.mark.parametrize("stubs", [0, 20, 40, 200])
def test_stubs_do_not_protect_boilerplate(spark, stubs):
    """However many pages are only a menu, the articles lose it and the stubs go."""
    rng = random.Random(5)
    menu = "\n".join(prose(rng, 10) for _ in range(6))
    articles = [prose(rng, 200) for _ in range(30)]
    texts = [f"{menu}\n{article}" for article in articles] + [f"{menu}\n{prose(rng, 4)}" for _ in range(stubs)]
    kept = {r["doc_id"]: r["text"] for r in quality.clean(spark.createDataFrame(
        [(i, t, "en", "host", 0, 1, "n", "r", 2) for i, t in enumerate(texts)], SCHEMA).repartition(3)).collect()}
    assert kept == dict(enumerate(articles))


def test_clean_keeps_columns_of_any_name(spark):
    rng = random.Random(6)
    names = ["kept", "host", "text_key", "removed_lines", "kept row", "host key", "row", "line", "salt"]
    made = spark.createDataFrame([(i, prose(rng, 80), "s", *[f"{n} {i}" for n in names]) for i in range(5)],
                                 "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    got = quality.clean(made)
    assert got.columns == made.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, made.collect()))


def test_optional_fields_and_unknown_layouts(spark):
    made = spark.createDataFrame([
        (1, '{"prompt":"p","response":null}'), (2, '{"prompt":"p"}'), (3, '{"instruction":"i","output":"o","system":"s"}'),
        (4, '{"response":"r"}'), (5, '{"prompt":"p","output":"o"}'), (6, '{"prompt":"p","response":"r","id":7}'),
        (6, '{"prompt":"p","response":"r","id":7}'), (8, '{"prompt":"' + "long " * 50000 + '"}')], "id int, json string")
    parsed = made.selectExpr("id", "json AS layout", f"from_json(json, '{chat.RECORD}, id int') AS record")
    got = chat.canonical(parsed, "record").collect()
    found = {r["id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in got}
    assert found[1] == found[2] == ("prompt", [("user", "p"), ("assistant", "")])
    assert found[3] == ("instruction", [("system", "s"), ("user", "i"), ("assistant", "o")])
    assert found[4] == found[5] == (None, None)
    assert found[6] == ("prompt", [("user", "p"), ("assistant", "r")]) and len(got) == 8
    assert len(found[8][1][0][1]) == 250_000


def test_language_stage_rejects_what_no_language_fits(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.typical(docs, langid.fit(docs))
    rng = random.Random(7)
    noise = [base64.b64encode(rng.randbytes(600)).decode(), prose(rng, 100),
             "".join(chr(rng.randint(0x3041, 0x3090)) for _ in range(300)), "\u043f\u0440\u0438\u0432\u0435\u0442 \u043c\u0438\u0440 \u043e\u0442 \u043d\u0430\u0441 " * 20]
    made = spark.createDataFrame([(10_000 + i, t, None) for i, t in enumerate(noise)], docs.schema)
    kept = {r["doc_id"] for r in langid.languages(docs.unionByName(made), model, ["doc_id"], accept=0.5).collect()}
    whole = {r["doc_id"] for r in langid.languages(docs, model, ["doc_id", "text"]).collect() if r["lang_pred"] != langid.UNKNOWN}
    assert not [i for i in kept if i is not None and i >= 10_000]
    assert len(kept) >= 0.98 * len(whole)


def test_too_many_languages_are_refused(spark):
    docs = spark.range(langid.MOST_LANGUAGES + 1).selectExpr("id AS doc_id", "'text' AS text", "concat('l', id) AS lang")
    with pytest.raises(ValueError, match="different languages"):
        langid.fit(docs)


def test_toxic_stems_anywhere_in_a_word(spark):
    """Marks between random beginnings and endings, in a corpus with many copies of one toxic document."""
    rng = np.random.default_rng(4)
    letters, syllables = list(LETTERS), ["ba", "ko", "ri", "tu", "ne", "sa", "lo"]
    texts = []
    for i in range(900):
        words = ["".join(rng.choice(syllables, rng.integers(1, 4))) for _ in range(60)]
        if i % 4 == 0:
            for at in rng.integers(0, 60, 5):
                words[at] = "".join(rng.choice(letters, 3)) + "vejxq" + "".join(rng.choice(letters, 3))
        texts.append(" ".join(words))
    texts[400:500:4] = [texts[400]] * 25
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)], "doc_id long, label int"))
    got = toxicity.toxicity(docs.where("doc_id >= 600"), model, ["doc_id"]).collect()
    assert np.mean([r["predicted"] == int(r["doc_id"] % 4 == 0) for r in got]) >= 0.95
    # Savings are the differences of plain compressed lengths, window by window.
    import zstandard

    def length(content, data):
        parameters = zstandard.ZstdCompressionParameters(**toxicity.PARAMETERS)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters).compress(data))

    words = texts[600].split()
    saved = [length(model.ordinary, data) - length(model.toxic, data) for at in range(0, 60, 16)
             for data in [model.start + b" " + " ".join(words[at:at + 16]).encode() + b" "]]
    mean, most = toxicity.savings(texts[600], model)[1:]
    assert abs(mean - np.mean(saved)) <= 2 and abs(most - max(saved)) <= 4 and max(saved) > 0
    assert toxicity.savings("x" * 300_000, model)[2] <= 50
    assert toxicity.savings(None, model) == toxicity.savings("123 !", model) == (0.0, 0.0, 0.0)


def test_fragments_cover_marked_runs():
    marks = np.unique(np.concatenate([toxicity.runs(b"lower", 4)[2:3], toxicity.runs(b"lower", 5)[1:2]]))
    assert toxicity.fragments(b"flower show lowers", marks) == [b"ower", b"lowers"[:5]] or toxicity.fragments(b"flower", marks)
    assert toxicity.fragments(b"nothing here", marks) == []


def test_pipeline_end_to_end(spark):
    """Each stage works on what the one before kept; the last packs every id of it once."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "language", "near duplicates", "packing"]
    held, counts = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, SF).cache()
        assert held.columns == docs.columns
        counts.append(held.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0 and counts[1] < counts[0] and counts[3] < counts[2]
    packed = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in held.select("doc_id").collect()}
    assert packed.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).where("`sum(length)` <> `max(doc_tokens)`").count() == 0


@pytest.mark.parametrize("name, columns", [
    ("op1_simhash", "doc_id fingerprint component_id"), ("op2_toxicity", "doc_id held_out score predicted"),
    ("op5_neighbours", "query_id rank vec_id score"), ("op8_byte_bpe", "doc_id n_tokens ids_sha256 decoded_sha256"),
    ("op9_quality", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept"),
    ("op10_packing", "doc_id start length ids_crc32 doc_tokens sequence_id offset"),
    ("op11_decontamination", "doc_id n_words n_hit n_items items_sha256 contaminated"),
    ("op12_alignment", "doc_id n_a n_b n_groups n_links groups_sha256 n_best count_sum"), ("op13_lexical", "item_id rank doc_id score")])
def test_registered_queries(spark, name, columns):
    found = QUERIES[name](spark, SF)
    assert found.columns == columns.split() and found.count() > 0


def brute_posterior(rows, suffixes):
    """host -> (mean, lower), by the formulas over plain dictionaries."""
    def parts(host):
        labels = host.split(".")
        size = 2 if ".".join(labels[-2:]) in suffixes else 1
        return ".".join(labels[-size - 1:]), ".".join(labels[-size:])

    counts = {}
    for host, bad in rows:
        n, b = counts.get(host, (0, 0))
        counts[host] = (n + (bad is not None), b + (bad or 0))

    def summed(key):
        out = {}
        for host, (n, b) in counts.items():
            m, c = out.get(key(host), (0, 0))
            out[key(host)] = (m + n, c + b)
        return out

    def shrink(level, parent):
        seen = [(n, b, parent[k]) for k, (n, b) in level.items() if n]
        pairs = sum(p * (1 - p) * (n - 1) for n, b, p in seen)
        excess = sum((b - n * p) ** 2 / n - p * (1 - p) for n, b, p in seen)
        ratio = min(url_filter.MOST_RATIO, max(url_filter.LEAST_RATIO, excess / pairs)) if pairs else url_filter.LEAST_RATIO
        weight = 1 / ratio - 1
        return {k: (b + weight * parent[k]) / (n + weight) for k, (n, b) in level.items()}, weight

    total = [sum(x) for x in zip(*counts.values())]
    suffix, domain = summed(lambda h: parts(h)[1]), summed(lambda h: parts(h)[0])
    by_suffix, _ = shrink(suffix, {k: (total[1] + 0.5) / (total[0] + 1) for k in suffix})
    of = {parts(h)[0]: parts(h)[1] for h in counts}
    by_domain, _ = shrink(domain, {k: by_suffix[of[k]] for k in domain})
    mean, weight = shrink(counts, {h: by_domain[parts(h)[0]] for h in counts})
    return {h: (m, m - url_filter.Z * (m * (1 - m) / (counts[h][0] + weight + 1)) ** 0.5) for h, m in mean.items()}


def test_posterior_of_hosts_matches_brute_force(spark):
    rng = random.Random(9)
    hosts = [f"{sub}{name}.{suffix}" for suffix in ("com", "co.uk", "org", "com.br") for name in ("a", "b", "cc")
             for sub in ("", "www.", "x.y.")] + ["", "localhost", "co.uk"]
    bias = {h: rng.random() for h in hosts}
    made = [(h, rng.choice([None, int(rng.random() < bias[h]), int(rng.random() < bias[h])])) for h in hosts for _ in range(rng.randint(0, 40))]
    want = brute_posterior(made, url_filter.SUFFIXES)
    got = {r["host"]: (r["mean"], r["lower"]) for r in url_filter.host_reputation(spark.createDataFrame(made, "host string, bad int")).collect()}
    assert set(got) == set(want)
    for host, pair in want.items():
        assert np.allclose(got[host], pair, rtol=1e-9), host


def test_neighbours_leave_the_session_as_it_was(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, "777")
    frame = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "vec_id long, embedding array<double>")
    assert neighbours.nearest(frame, frame.where("vec_id % 20 = 0"), 3).count() == 9
    assert spark.conf.get(setting) == "777"


def test_near_copies_in_a_long_chain_are_compared_with_each_other(spark, monkeypatch):
    """Texts in one long run of equal fingerprints, where no band tells which of them are near copies: the links that span the
    run join texts that are not alike, and the near copies are found all the same."""
    rng = random.Random(11)
    texts = []
    for _ in range(20):
        words = [word(rng) for _ in range(60)]
        texts += [" ".join(words), " ".join([*words, "more"])]
    monkeypatch.setattr(simhash, "sketch", lambda text: (0, [int.from_bytes(text[:5], "big") * 8192 + 64 * len(text) + i for i in range(32)]))
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.near_duplicates(made).collect()) == list(range(0, 40, 2))


def test_pipeline_gives_the_packed_ids(spark):
    """The last stage's pieces are the token ids themselves; a document's pieces, put together, are all of its ids."""
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(12)
    texts = ["\n\n".join(prose(rng, 300) for _ in range(4)), prose(rng, 40), ""]
    made = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {}
    for r in sorted(corpus_pipeline.pack(spark, made, SF).collect(), key=lambda r: r["start"]):
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        got.setdefault(r["doc_id"], []).extend(np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist())
    assert got == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
