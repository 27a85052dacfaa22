"""Toxicity by compression distance: windows of a text are compressed with a dictionary trained on toxic text and
with one trained on ordinary text, and the bytes that the toxic one saves decide.

Both dictionaries come from zstandard's own trainer. Whole toxic texts would not do: most of their words are ordinary,
the trainer picks what is frequent, and the two dictionaries then hardly differ (area under the curve 0.63). So the
toxic training text is the fragments that tell toxic documents apart: stretches of words covered by runs of 4 to 6
bytes that more toxic than ordinary documents have, by a test of significance and of a ratio. A fragment may stand
anywhere in a word, so inflected, compound and prefixed forms count. Copies and near copies count once there. The ordinary dictionary is trained on windows of
ordinary text. The toxic one is loaded before that same ordinary one, so that ordinary words cost the same with both
and only what is toxic differs. Windows are compressed as they are, lower-case letters and single spaces, with the
optimal parser: the fast ones miss most matches of a few bytes.

Fitting takes a bounded sample: about `sample` labelled documents of each class and part, two thirds of the labelled
ones for the dictionaries and the others for the calibration, which weighs each class back to its share of the labels,
so that 0.5 means the same at any size. Only marked runs, fragments, chosen windows and per-document savings reach the
driver. The documents of a language are marked like any others: it needs some dozens of toxic ones in the sample.

Defined results: a null or empty text, and one without letters, has no savings and gets the calibrated score of that;
a document labelled twice counts as toxic if any label says so; repeated rows score alike; a long text has more
windows, and a window of over 4,096 bytes is cut; without labels of both classes every score is 0; an empty table
gives no rows; extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import bounded_sample, settle, small_batches

# Words and bytes of a window.
WINDOW_WORDS, WINDOW_BYTES = 16, 4096
SAMPLE = 3000
# Bytes of the runs that are rated, and when one is a mark: this many standard errors and this ratio of the shares.
RUNS = (4, 5, 6)
MARK_SIGMA, MARK_RATIO = 6.0, 6.0
# A document that has one of so many smallest shingle hashes in common with an earlier one is a copy.
COPY_SEEDS = 4
# Sizes of the ordinary dictionary, its training windows and their number; the toxic one grows with its fragments.
ORDINARY_BYTES, TRAINING_WINDOW, TRAINING_WINDOWS = 16_384, 2000, 3000
TOXIC_BYTES = (8_192, 65_536)
PARAMETERS = {"window_log": 19, "hash_log": 17, "chain_log": 17, "search_log": 4, "min_match": 4,
              "strategy": zstandard.STRATEGY_BTOPT, "target_length": 0, "write_content_size": False,
              "write_checksum": False, "write_dict_id": False, "format": zstandard.FORMAT_ZSTD1_MAGICLESS}
LETTERS = bytes(c if chr(c).isalpha() or c > 127 else 32 for c in range(256))


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    start: bytes
    center: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]


def plain(text: str | None) -> bytes:
    """Lower-case words of letters, single spaces between."""
    return b" ".join((text or "").lower().encode().translate(LETTERS).split())


def windows(words: list[bytes]) -> list[bytes]:
    """The text in stretches of words, each with a space around."""
    found = [b" " + b" ".join(words[at:at + WINDOW_WORDS]) + b" " for at in range(0, len(words), WINDOW_WORDS)]
    return [own[at:at + WINDOW_BYTES] for own in found for at in range(0, len(own), WINDOW_BYTES)]


@functools.lru_cache(maxsize=4)
def _compressors(toxic: bytes, ordinary: bytes):
    made = []
    for content in (toxic, ordinary):
        parameters = zstandard.ZstdCompressionParameters(**PARAMETERS)
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=parameters)
        made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters))
    return made


def savings(text: str | None, model: Model) -> tuple[float, float, float]:
    """Bytes that the toxic dictionary saves: mean of the gains, mean, and most in a window. Windows go with a
    compressible stretch before them, as zstandard otherwise stores short input as it is."""
    toxic, ordinary = _compressors(model.toxic, model.ordinary)
    saved = [len(ordinary.compress(model.start + own)) - len(toxic.compress(model.start + own)) for own in windows(plain(text).split())]
    if not saved:
        return 0.0, 0.0, 0.0
    return sum(max(s, 0) for s in saved) / len(saved), sum(saved) / len(saved), float(max(saved))


def score(saved, model: Model) -> np.ndarray:
    scaled = (np.asarray(saved, dtype=float).reshape(-1, 3) - model.center) / model.spread
    line = scaled @ np.array(model.weights[:3]) + model.weights[3]
    return 1 / (1 + np.exp(-np.clip(line, -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method with a small penalty; each row stands for `counts` rows."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (counts * (p - y)) + ridge * w
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _map_texts(docs: DataFrame, columns: list[str], made, schema: str) -> DataFrame:
    """Apply made(texts) -> further columns to rows of (columns..., text), a batch at a time."""
    def run(batches):
        for batch in batches:
            kept = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, *made(batch.column(len(columns)).to_pylist())], names)

    names = [*columns, *[part.split()[0] for part in schema.split(", ")]]
    types = [f"{name} {docs.schema[name].dataType.simpleString()}" for name in columns]
    return docs.select(*columns, "text").mapInArrow(run, ", ".join([*types, schema]))


def runs(words: bytes, size: int) -> np.ndarray:
    """All runs of `size` bytes that lie in one word with the space before or behind it, as numbers, by position; 0
    where a run has a space inside."""
    data = np.frombuffer(b" " + words + b" ", dtype=np.uint8).astype(np.uint64)
    count = len(data) - size + 1
    if count < 1:
        return np.empty(0, dtype=np.uint64)
    code, inside = np.full(count, size, dtype=np.uint64), np.ones(count, dtype=bool)
    for at in range(size):
        code = (code << np.uint64(8)) | data[at:at + count]
        if 0 < at < size - 1:
            inside &= data[at:at + count] != 32
    return np.where(inside, code, np.uint64(0))


def fragments(words: bytes, marks: np.ndarray) -> list[bytes]:
    """The stretches that marked runs cover; marks are in ascending order."""
    covered = np.zeros(len(words) + 2, dtype=bool)
    for size in RUNS:
        found = runs(words, size)
        at = np.minimum(np.searchsorted(marks, found), len(marks) - 1)
        hit = np.flatnonzero((marks[at] == found) & (found > 0))
        for place in range(size):
            covered[hit + place] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.astype(np.int8), [0]))))
    data = b" " + words + b" "
    return [data[a:b] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


def shingle_minima(words: list[bytes]) -> list[int]:
    """For each of COPY_SEEDS, the smallest hash of five words in a row."""
    own = {b" ".join(words[at:at + 5]) for at in range(max(1, len(words) - 4))}
    return [min(xxhash.xxh3_64_intdigest(shingle, seed) for shingle in own) >> 1 for seed in range(COPY_SEEDS)]


def _without_copies(sample: DataFrame) -> DataFrame:
    """One document of each group of copies and near copies, which would make marks of all that they have in common."""
    def run(batches):
        for batch in batches:
            minima = [shingle_minima(plain(text).split()) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(minima, pa.list_(pa.int64()))], ["row", "minima"])

    rows = settle(sample.withColumn("row", F.monotonically_increasing_id()), "toxicity-sample")
    minima = rows.select("row", "text").mapInArrow(run, "row long, minima array<long>").select(
        "row", F.posexplode("minima").alias("seed", "minimum"))
    first = minima.groupBy("seed", "minimum").agg(F.min("row").alias("first"))
    copies = minima.join(first, ["seed", "minimum"]).where("row > first").select("row").distinct()
    return rows.join(copies, "row", "left_anti").drop("row")


def _run_counts(sample: DataFrame) -> DataFrame:
    """(run, toxic, ordinary): documents of each class that have the run."""
    def count(batches):
        for batch in batches:
            labels = np.array(batch.column(1).to_pylist(), dtype=np.int64)
            found = [np.unique(np.concatenate([runs(words, size) for size in RUNS]))
                     for words in map(plain, batch.column(0).to_pylist())]
            own, place = np.unique(np.concatenate([*found, np.empty(0, dtype=np.uint64)]), return_inverse=True)
            toxic = np.bincount(place, np.repeat(labels, list(map(len, found))), len(own)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.view(np.int64)), pa.array(toxic), pa.array(np.bincount(place, minlength=len(own)) - toxic)],
                ["run", "toxic", "ordinary"])

    rows = sample.select("text", F.col("label").cast("int").alias("label")).mapInArrow(count, "run long, toxic long, ordinary long")
    return rows.where("run <> 0").groupBy("run").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _train(samples: list[bytes], size: int) -> bytes:
    """The trainer's dictionary; of too little text, the text itself, the end of it if there is more than fits."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def _toxic_samples(sample: DataFrame, marks: np.ndarray) -> list[bytes]:
    """Each toxic document's different fragments."""
    held = sample.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        for batch in batches:
            found = [b" ".join(sorted(set(fragments(plain(text), held.value)))) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f for f in found if f], pa.binary())], ["fragments"])

    return sorted(bytes(r[0]) for r in sample.where("label = 1").select("text").mapInArrow(run, "fragments binary").collect())


def _ordinary_samples(sample: DataFrame) -> list[bytes]:
    """Windows of ordinary documents, about TRAINING_WINDOWS whatever there is, chosen by a hash."""
    ordinary = sample.where("label = 0").select("text")
    total = ordinary.agg(F.coalesce(F.sum(1 + F.floor(F.octet_length("text") / TRAINING_WINDOW)), F.lit(0))).first()[0]

    def run(batches):
        for batch in batches:
            found = [own[at:at + TRAINING_WINDOW] for own in map(plain, batch.column(0).to_pylist())
                     for at in range(0, len(own), TRAINING_WINDOW)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["window"])

    chosen = F.pmod(F.xxhash64("window"), F.lit(max(1, total))) < TRAINING_WINDOWS
    return sorted(bytes(r[0]) for r in ordinary.mapInArrow(run, "window binary").where(chosen).collect())


def _dictionaries(sample: DataFrame) -> tuple[bytes, bytes, bytes] | None:
    sizes = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    many, few = sizes.get(0, 0), sizes.get(1, 0)
    if not many or not few:
        return None
    share, rest = F.col("toxic") / few, F.col("ordinary") / many
    pooled = (F.col("toxic") + F.col("ordinary")) / (few + many)
    sigma = (share - rest) / F.sqrt(pooled * (1 - pooled) * (1 / few + 1 / many) + 1e-12)
    rated = _run_counts(sample).where((sigma >= MARK_SIGMA) & (share >= MARK_RATIO * rest)).select("run")
    marks = np.array(sorted(r["run"] for r in rated.collect()), dtype=np.int64).view(np.uint64)
    # What stands nearest to the end is found first and costs least. No match begins at a dictionary's very start.
    lead = b" " * 16
    ordinary = lead + _train(_ordinary_samples(sample), ORDINARY_BYTES)[-ORDINARY_BYTES:]
    found = _toxic_samples(sample, marks) if len(marks) else []
    times = Counter(f for own in found for f in own.split())
    toxic = _train(found, min(max(4 * sum(len(f) + 1 for f in times), TOXIC_BYTES[0]), TOXIC_BYTES[1])) if found else b""
    # The trainer drops what is rare, such as the fragments of a language with few documents.
    left = [f for f, _ in sorted(times.items(), key=lambda x: (x[1], x[0])) if f not in toxic]
    return lead + b" ".join([b"", *left, toxic]) + ordinary, ordinary, ordinary[-96:]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """docs: doc_id, text. labels: doc_id, label (0 or 1). None if a class has no document."""
    small_batches(docs.sparkSession)
    once = labels.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    shares = {row["label"]: row["count"] for row in once.groupBy("label").count().collect()}
    parts = []
    third = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)) == 0
    for part, own in enumerate((once.where(~third), once.where(third))):
        # At most about 2 x sample ids: the bound makes the broadcast safe.
        chosen = F.broadcast(bounded_sample(own, "label", "doc_id", sample, f"toxicity-{part}"))
        parts.append(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "label"))
    contents = _dictionaries(settle(_without_copies(parts[0]), "toxicity-different"))
    if contents is None:
        return None
    draft = Model(*contents, (0.0,) * 3, (1.0,) * 3, (0.0,) * 4)
    rows = _map_texts(parts[1], ["label"], lambda found: _columns(found, draft),
                      "gains double, mean double, most double").toPandas()
    if rows["label"].nunique() < 2:
        return None
    x, y = rows[["gains", "mean", "most"]].to_numpy(), rows["label"].to_numpy(dtype=int)
    center, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    # Each class as often as among all labels, at the size of the sample.
    counts = np.array([shares[0], shares[1]]) / (shares[0] + shares[1]) * len(y) / np.bincount(y, minlength=2)
    weights = _logistic((x - center) / spread, y.astype(float), counts[y])
    return Model(*contents, tuple(center), tuple(spread), tuple(weights))


def _columns(found: list, model: Model) -> list[pa.Array]:
    rows = np.array([savings(text, model) for text in found], dtype=float).reshape(-1, 3)
    return [pa.array(rows[:, i]) for i in range(3)]


def toxicity(docs: DataFrame, model: Model | None, columns: list[str]) -> DataFrame:
    """The named columns and score, gain (bytes saved a window), predicted, for every whole text."""
    small_batches(docs.sparkSession)
    schema = "score double, gain double, predicted int"
    if model is None:
        return docs.select(*columns, F.lit(0.0).alias("score"), F.lit(0.0).alias("gain"), F.lit(0).alias("predicted"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def made(found):
        rows = np.array([savings(text, held.value) for text in found], dtype=float).reshape(-1, 3)
        scores = score(rows, held.value)
        return [pa.array(scores), pa.array(rows[:, 0]), pa.array((scores >= 0.5).astype(np.int32))]

    return _map_texts(docs, columns, made, schema)
