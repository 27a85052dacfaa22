"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts become lower-case letters with single spaces for all else; n-grams of two and three characters are hashed
into 2^16 buckets by integer arithmetic over whole batches, and the broadcast matrix of log probabilities
(buckets x languages) is gathered and summed by document.

The model is fitted on a bounded sample: at most about `sample` documents of each language. A posterior says which of
the learned languages fits best, not whether any fits, and is near 1 for any text of some length. So `typical` adds to
a model how likely an n-gram of each language's labelled documents is on average, and `languages` can reject texts
far below that: other languages, encoded data, random letters.

Defined results: a null text or one without a letter is `und` with score 0; null labels teach nothing; the
smaller name wins a tie; without any label every text is `und`; equal rows score alike; a long text is scored in
pieces; an empty table gives no rows; extra columns, whatever their names, are kept if asked for and not read. Over
MOST_LANGUAGES different labels are refused, as the model has a column for each.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import bounded_sample, small_batches

BUCKETS = 1 << 16
ORDERS = (2, 3)
SAMPLE = 4000
SMOOTHING = 0.5
MOST_LANGUAGES = 1000
# A text is rejected if it lies below its language's rarest labelled documents (this share) by so much of their distance
# to the median, and by LEAST_GAP nats below the median at least. Texts in two of the languages lie above, at some 2 nats.
RAREST, MARGIN, LEAST_GAP = 0.001, 0.75, 2.5
# Characters that are turned into n-grams at once.
PIECE = 1 << 20
UNKNOWN = "und"
SPACE = 32


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    log_likelihood: np.ndarray  # buckets x languages, float32
    log_prior: np.ndarray
    # The least mean log probability of an n-gram that a text of each language has; see `typical`.
    floor: np.ndarray | None = None


@functools.cache
def _letter_table() -> np.ndarray:
    """Each code point's lower-case letter, or a space."""
    table = np.full(0x110000, SPACE, dtype=np.uint32)
    for code in range(0x110000):
        if chr(code).isalpha():
            lower = chr(code).lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def letters(text: str | None) -> np.ndarray:
    """Code points of the text's lower-case letters, with single spaces between and around words."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _letter_table()[np.concatenate(([SPACE], codes, [SPACE]))]
    space = codes == SPACE
    return codes[~(space & np.concatenate(([False], space[:-1])))]


def buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """The bucket of each n-gram of the code points."""
    count = len(codes) - order + 1
    if count <= 0:
        return np.empty(0, dtype=np.int64)
    mixed = np.full(count, order, dtype=np.uint32)
    for offset in range(order):
        mixed = (mixed ^ codes[offset:offset + count]) * np.uint32(0x9E3779B1)
        mixed ^= mixed >> np.uint32(15)
    return (mixed & np.uint32(BUCKETS - 1)).astype(np.int64)


def _bucket_counts(codes: np.ndarray) -> np.ndarray:
    return sum(np.bincount(buckets(codes, order), minlength=BUCKETS) for order in ORDERS)


def _labelled_sample(docs: DataFrame, sample: int) -> DataFrame:
    labelled = docs.where("lang is not null").select("doc_id", "text", "lang")
    if labelled.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} different languages are named")
    return bounded_sample(labelled, "lang", "doc_id", sample, "langid")


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """docs: doc_id, text, lang. None if no document has a label."""
    small_batches(docs.sparkSession)
    chosen = _labelled_sample(docs, sample)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes = letters(text)
                counts = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                for at in range(0, len(codes), PIECE):
                    counts += _bucket_counts(codes[at:at + PIECE + max(ORDERS) - 1])
                rows[lang] = rows.get(lang, 0) + 1
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int32()),
                 pa.array(np.append(counts[at], rows[lang]), pa.int64())], ["lang", "bucket", "n"])

    counted = chosen.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if table.empty:
        return None
    languages = sorted(table["lang"].unique())
    place = {name: i for i, name in enumerate(languages)}
    counts, documents = np.zeros((BUCKETS, len(languages))), np.zeros(len(languages))
    column = table["lang"].map(place).to_numpy()
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    is_row = bucket < 0
    documents[column[is_row]] = n[is_row]
    counts[bucket[~is_row], column[~is_row]] = n[~is_row]
    likelihood = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS))
    return Model(tuple(languages), likelihood.astype(np.float32), np.log(documents / documents.sum()))


def log_scores(found: list[np.ndarray], model: Model) -> np.ndarray:
    """Documents x languages: joint log probabilities, in pieces of bounded size."""
    out = np.tile(model.log_prior, (len(found), 1))
    held: list[np.ndarray] = []
    owners: list[int] = []

    def flush():
        if not held:
            return
        for order in ORDERS:
            places = [buckets(codes, order) for codes in held]
            sizes = np.array([len(x) for x in places])
            if not sizes.sum():
                continue
            full = np.flatnonzero(sizes)
            starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
            gathered = model.log_likelihood[np.concatenate(places)]
            np.add.at(out, np.array(owners)[full], np.add.reduceat(gathered, starts, axis=0, dtype=np.float64))
        held.clear()
        owners.clear()

    waiting = 0
    for owner, codes in enumerate(found):
        for at in range(0, len(codes), PIECE):
            held.append(codes[at:at + PIECE + max(ORDERS) - 1])
            owners.append(owner)
            waiting += len(held[-1])
            if waiting >= PIECE:
                flush()
                waiting = 0
    flush()
    return out


def identify(found: list[str | None], model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, its posterior probability, and the mean log probability of an n-gram in it, for each text."""
    codes = [letters(text) for text in found]
    known = np.array([bool((x != SPACE).any()) for x in codes], dtype=bool)
    logs = log_scores(codes, model)
    best = logs.argmax(axis=1) if len(found) else np.empty(0, dtype=int)
    sure = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1) if len(found) else np.empty(0)
    names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, known, strict=True)]
    grams = np.array([sum(max(0, len(x) - order + 1) for order in ORDERS) for x in codes])
    mean = (logs[np.arange(len(found)), best] - model.log_prior[best]) / np.maximum(grams, 1)
    return names, np.where(known, sure, 0.0), mean


def typical(docs: DataFrame, model: Model | None, sample: int = SAMPLE) -> Model | None:
    """The model with a floor for each language, below all but outlandish texts: see RAREST. A language without
    documents of its own rejects nothing."""
    if model is None:
        return None
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, _, mean = identify(batch.column(0).to_pylist(), held.value)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(names, pa.string()), pa.array(mean)], ["lang", "found", "mean"])

    rows = _labelled_sample(docs, sample).select("text", "lang").mapInArrow(run, "lang string, found string, mean double")
    found = {r["lang"]: r for r in rows.where("lang = found").groupBy("lang").agg(
        F.percentile_approx("mean", RAREST, 10_000).alias("rarest"), F.percentile_approx("mean", 0.5, 10_000).alias("half")).collect()}
    floor = [min((1 + MARGIN) * found[name]["rarest"] - MARGIN * found[name]["half"], found[name]["half"] - LEAST_GAP)
             if name in found else -np.inf for name in model.languages]
    return replace(model, floor=np.array(floor))


def languages(docs: DataFrame, model: Model | None, columns: list[str], text_col: str = "text",
              accept: float | None = None) -> DataFrame:
    """The named columns, lang_pred and score for every whole text.

    With `accept`, only the named columns of the documents that have a language and that score at least, and are
    as likely in it as the model's floor asks.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    fields = [docs.schema[name] for name in columns]
    names = columns if accept is not None else [*columns, "lang_pred", "score"]
    schema = ", ".join([f"`{field.name}` {field.dataType.simpleString()}" for field in fields]
                       + ([] if accept is not None else ["lang_pred string", "score double"]))

    def run(batches):
        for batch in batches:
            found = batch.column(len(columns)).to_pylist()
            if held.value is None:
                best, sure, mean = [UNKNOWN] * len(found), np.zeros(len(found)), np.zeros(len(found))
            else:
                best, sure, mean = identify(found, held.value)
            kept = [batch.column(i) for i in range(len(columns))]
            if accept is None:
                yield pa.RecordBatch.from_arrays([*kept, pa.array(best, pa.string()), pa.array(sure)], names)
            else:
                floor = dict(zip(held.value.languages, held.value.floor, strict=True)) if held.value and held.value.floor is not None else {}
                keep = pa.array([name != UNKNOWN and p >= accept and m >= floor.get(name, -np.inf)
                                 for name, p, m in zip(best, sure, mean, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([column.filter(keep) for column in kept], names)

    return docs.select(*columns, F.col(text_col).alias("text of the row")).mapInArrow(run, schema)
