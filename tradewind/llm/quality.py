"""Quality rules: base measures of every text, and lines that too many documents of a host share.

Lines are lower-cased, their digits made zeros and their white space single, then hashed. A line that over
`max_documents` different texts of one host have, is frequent. A text is depleted if too few of its words would be left
without its frequent lines. A frequent line is boilerplate if over `max_documents` texts that are not depleted have it,
however many depleted ones (stubs) have it too. Boilerplate lines are removed, and a document is rejected if it fails
the base rules or if too few of its words are left. A line that only depleted texts have is what copies and edited
copies of one text have in common; were it removed, all of them would go and none be left, so that is for the
near-duplicate stage to judge. For the same reason exact copies count as one text.

Counts are summed before they meet, and the joins of lines with the few frequent ones are salted, so that a line that
a large share of a host has does not gather in one task.

Defined results: a null text has no words and fails the base rules; a null host is a host of its own; equal rows
get equal verdicts and are all returned; an empty table gives no rows; extra columns, whatever their names, are kept by
`clean` and not read; a long text is one row with its different lines.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import settle, small_batches, text_key, texts

LEAST_WORDS = 50
MOST_REPEATED = 50
SPACES, SYMBOLS = b" \t\n\v\f\r", b"#*$%&|<>"
DIGITS = re.compile(rb"[0-9]+")
MAX_DOCUMENTS = 10
# A text is depleted if fewer words, or a smaller share of its words, are left.
LEFT_WORDS, LEFT_SHARE = 20, 0.3
# Tasks that the rows of one frequent line are spread over.
SALTS = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found at least twice."""
    count = len(words)
    if count < 4:
        return 0
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(word, len(number)) for word in words], dtype=np.int64)
    pairs = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)[1].astype(np.int64)
    _, place, times = np.unique(pairs[:-1] * len(number) + codes[2:], return_inverse=True, return_counts=True)
    twice = times[place] > 1
    covered = np.zeros(count, dtype=bool)
    for offset in range(3):
        covered[offset:offset + count - 2] |= twice
    return int(covered.sum())


def normalised(line: bytes) -> bytes:
    """The form that decides whether two lines are the same; empty if the line has no word."""
    return b" ".join(DIGITS.sub(b"0", line.decode(errors="replace").lower().encode()).split())


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    solid = text.translate(None, SPACES)
    word_chars = len(solid) if solid.isascii() else len(solid.decode())
    lines = Counter(line for line in text.split(b"\n") if line.strip(SPACES))
    return (len(words), word_chars, len(solid) - len(solid.translate(None, SYMBOLS)),
            sum(lines.values()) - len(lines), repeated_words(words))


def line_words(text: bytes) -> dict[int, int]:
    """For each distinct normalised line with a word: its hash, and the words of its occurrences."""
    found: dict[int, int] = {}
    for line in text.split(b"\n"):
        if form := normalised(line):
            key = xxhash.xxh3_64_intdigest(form) - (1 << 63)
            found[key] = found.get(key, 0) + form.count(b" ") + 1
    return found


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _measured(docs: DataFrame, id_col: str, host_col: str, text_col: str) -> DataFrame:
    """Measures of each row, its text's key, and its distinct lines."""
    small_batches(docs.sparkSession)
    id_type, host_type = (docs.schema[name].dataType.simpleString() for name in (id_col, host_col))
    names = ["id", "host", *MEASURES, "text_key", "lines", "words"]

    def run(batches):
        for batch in batches:
            found = texts(batch.column(2))
            measures = [measure(text) for text in found]
            lines = [line_words(text) for text in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 *[pa.array(column, pa.int64()) for column in (zip(*measures, strict=True) if measures else [()] * 5)],
                 batch.column(3),
                 pa.array([list(x) for x in lines], pa.list_(pa.int64())),
                 pa.array([list(x.values()) for x in lines], pa.list_(pa.int32()))], names)

    kinds = ", ".join(f"{name} long" for name in MEASURES)
    return docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), F.col(text_col).alias("text"),
                       text_key(text_col).alias("text_key")).mapInArrow(
        run, f"id {id_type}, host {host_type}, {kinds}, text_key binary, lines array<long>, words array<int>")


def _of_lines(lines: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of some (host, line); those of one line are spread over SALTS tasks."""
    salted = chosen.select("host", "line", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = lines.withColumn("salt", F.pmod(F.xxhash64("text_key"), F.lit(SALTS)).cast("int"))
    return own.join(salted, ["host", "line", "salt"]).drop("salt")


def _depleted(n_words: str, removed: str) -> Column:
    left = F.col(n_words) - F.col(removed)
    return (left < LEFT_WORDS) | (left < LEFT_SHARE * F.col(n_words))


def _boilerplate(rows: DataFrame, max_documents: int) -> DataFrame:
    """(host, text_key, removed_lines, removed_words) of the texts that have boilerplate lines."""
    different = rows.select(F.coalesce(F.col("host").cast("string"), F.lit("\0")).alias("host"), "text_key", "n_words",
                            "lines", "words").dropDuplicates(["host", "text_key"])
    lines = settle(different.select("host", "text_key", "n_words", F.explode(F.arrays_zip("lines", "words")).alias("x")).select(
        "host", "text_key", "n_words", F.col("x.lines").alias("line"), F.col("x.words").alias("words")), "quality-lines")
    frequent = lines.groupBy("host", "line").count().where(F.col("count") > max_documents)
    carried = settle(_of_lines(lines, frequent), "quality-frequent")
    whole = carried.groupBy("host", "text_key").agg(
        F.first("n_words").alias("n_words"), F.sum("words").alias("removed")).where(
        ~_depleted("n_words", "removed")).select("host", "text_key")
    boilerplate = carried.join(whole, ["host", "text_key"], "left_semi").groupBy("host", "line").count().where(
        F.col("count") > max_documents)
    removed = _of_lines(carried, boilerplate).groupBy("host", "text_key").agg(
        F.sort_array(F.collect_list("line")).alias("removed_lines"), F.sum("words").alias("removed_words"))
    return settle(removed, "quality-removed")


def _judged(rows: DataFrame, removed: DataFrame) -> DataFrame:
    keys = removed.select(F.col("host").alias("host key"), F.col("text_key").alias("text key"), "removed_lines",
                          "removed_words")
    joined = rows.drop("lines", "words").join(
        keys, (F.coalesce(F.col("host").cast("string"), F.lit("\0")) == F.col("host key"))
        & (F.col("text_key") == F.col("text key")), "left").drop("host key", "text key")
    joined = joined.withColumn("base_failed", base_failed()).withColumn(
        "left_words", F.col("n_words") - F.coalesce("removed_words", F.lit(0)))
    depleted = F.col("removed_words").isNotNull() & _depleted("n_words", "removed_words")
    return joined.withColumn("kept", ~F.col("base_failed") & ~depleted)


def judge(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
          max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(id, host, measures, text_key, removed_lines, removed_words, base_failed, left_words, kept) for every row."""
    rows = settle(_measured(docs, id_col, host_col, text_col), "quality-measures")
    return _judged(rows, _boilerplate(rows, max_documents))


def clean(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text",
          chars_col: str | None = "n_chars", max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """The kept rows, with the columns of docs; boilerplate lines are taken out of their texts."""
    rows = settle(_measured(docs, id_col, host_col, text_col), "quality-measures")
    verdicts = _judged(rows, _boilerplate(rows, max_documents)).where("not kept or removed_words is not null").select(
        F.coalesce(F.col("host").cast("string"), F.lit("\0")).alias("host"), "text_key", "kept", "removed_lines").dropDuplicates(
        ["host", "text_key"])
    names, kinds = docs.columns, [field.dataType.simpleString() for field in docs.schema]
    at, chars = names.index(text_col), names.index(chars_col) if chars_col in names else None

    def without(batches):
        for batch in batches:
            columns = [batch.column(i) for i in range(len(names))]
            drops = batch.column(len(names)).to_pylist()
            if any(drops):
                old = columns[at].to_pylist()
                sizes = columns[chars].to_pylist() if chars is not None else None
                for i, lines in enumerate(drops):
                    if lines:
                        gone = set(lines)
                        old[i] = b"\n".join(
                            line for line in old[i].encode().split(b"\n") if not (form := normalised(line))
                            or xxhash.xxh3_64_intdigest(form) - (1 << 63) not in gone).decode()
                        if sizes is not None:
                            sizes[i] = len(old[i])
                columns[at] = pa.array(old, columns[at].type)
                if sizes is not None:
                    columns[chars] = pa.array(sizes, columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = ", ".join(f"`{name}` {kind}" for name, kind in zip(names, kinds, strict=True))
    # The row goes as one struct, so that no column of it can clash with a name used here.
    held = docs.select(F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
                       F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("\0")).alias("host"),
                       text_key(text_col).alias("text_key"))
    kept = held.join(verdicts, ["host", "text_key"], "left").where(F.coalesce("kept", F.lit(True)))
    columns = [F.col("row").getField(name).alias(f"c{n}") for n, name in enumerate(names)]
    return kept.select(*columns, "removed_lines").mapInArrow(without, fields)
