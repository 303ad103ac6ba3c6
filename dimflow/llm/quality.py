"""Quality rules: base statistics of a text and the frequency of its lines on a host.

Lines that very many documents of a host share are navigation, notices and other
boilerplate.  Each line is normalised and hashed; the distinct documents that
hold it are counted per host; lines above the limits go; a document that loses
most of its words with them is rejected.

* Documents are told apart by their text, so copies of one text count once.
* The first document of a host that holds a line (lowest key) keeps it, so what
  a host says in many places stays in one.
* Counting is two plain aggregations with map-side combine, keyed by host and
  line hash, so neither a host nor a line that holds a third of all rows gathers
  in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.storage import Stored
from dimflow.llm.tokens import slices

WHITE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))

MIN_DOCUMENTS = 20  # a line in at most so many documents of a host stays
HOST_SHARE = 100  # and so does one in at most a 100th of the host's documents,
MOST_DOCUMENTS = 10_000  # unless it is in more than so many
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words in repeated windows
LEAST_LEFT = 30  # per cent of words that must remain

FEATURES = (
    "key bigint, host string, text_hash binary, n_words bigint, word_chars bigint, "
    "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "lines array<struct<hash:binary,words:int>>"
)


def line_hash(line: bytes) -> bytes:
    """128 bits of a line, with A-Z lowered and white space runs as one space."""
    return hashlib.blake2b(b" ".join(line.lower().split()), digest_size=16).digest()


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    codes: dict[bytes, int] = {}
    code = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    pairs = np.unique(code[:-1] * len(codes) + code[1:], return_inverse=True)[1]
    _, window, times = np.unique(
        pairs[:-1] * len(codes) + code[2:], return_inverse=True, return_counts=True
    )
    again = times[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def describe(text: bytes) -> tuple:
    words = text.split()
    lines: dict[bytes, int] = {}
    n_lines, distinct = 0, set()
    for line in text.split(b"\n"):
        if n := len(line.split()):
            n_lines += 1
            distinct.add(line)
            hashed = line_hash(line)
            lines[hashed] = lines.get(hashed, 0) + n
    return (
        len(words),
        len(text.translate(None, WHITE + CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        n_lines - len(distinct),
        repeated_words(words),
        list(lines),
        list(lines.values()),
    )


def features(docs: DataFrame, key: str, text: str, host: str) -> DataFrame:
    """Base statistics, text hash and distinct lines of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                describe(t or b"")
                for part in slices(batch, "text")
                for t in part.column("text").cast(pa.binary()).to_pylist()
            ]
            sizes = np.fromiter((len(f[5]) for f in found), np.int32, len(found))
            lines = pa.StructArray.from_arrays(
                [
                    pa.array([h for f in found for h in f[5]], pa.binary()),
                    pa.array([n for f in found for n in f[6]], pa.int32()),
                ],
                ["hash", "words"],
            )
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("host"),
                    batch.column("text_hash"),
                    *[pa.array([f[i] for f in found], pa.int64()) for i in range(5)],
                    pa.ListArray.from_arrays(offsets, lines),
                ],
                names=[
                    "key", "host", "text_hash", "n_words", "word_chars", "n_symbols",
                    "n_dup_lines", "n_repeat_words", "lines",
                ],
            )

    chosen = docs.select(
        F.col(key).cast("bigint").alias("key"),
        host_of(host).alias("host"),
        text_hash_of(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    return chosen.mapInArrow(run, FEATURES)


def host_of(column: str):
    """The host, with one of its own for nulls."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def text_hash_of(column: str):
    return F.unhex(F.md5(F.coalesce(F.col(column), F.lit(""))))


def judge(
    docs: DataFrame, held: Stored, key: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """One row per document: its statistics, ``base_failed``, ``removed_words``,
    the hashes of its ``removed`` lines, and ``kept``.

    A null or empty text has no words and fails the base rules.  Rows that repeat
    a key or a text are judged alike, each with a row of its own.  Documents with
    a null host share a host; a null key ranks after all others when the first
    holder of a line is chosen.  An empty table gives no rows; other columns are
    ignored.
    """
    found = features(docs, key, text, host).withColumn("row", F.monotonically_increasing_id())
    found = held.keep(found)
    held_lines = found.select(
        "row", "host", "text_hash", "key", F.explode("lines").alias("line")
    ).select("row", "host", "text_hash", "key", "line.hash", "line.words")
    per_text = held_lines.groupBy("host", "hash", "text_hash").agg(F.min("key").alias("key"))
    first = F.struct(F.col("key").isNull().alias("absent"), "key", "text_hash")
    per_line = per_text.groupBy("host", "hash").agg(
        F.count("*").alias("documents"), F.min(first).alias("first")
    )
    sizes = found.groupBy("host", "text_hash").agg(F.lit(1)).groupBy("host").agg(
        F.count("*").alias("host_documents")
    )
    frequent = (
        per_line.filter(F.col("documents") > MIN_DOCUMENTS)
        .join(sizes, "host")
        .filter(
            (F.col("documents") * HOST_SHARE > F.col("host_documents"))
            | (F.col("documents") > MOST_DOCUMENTS)
        )
        .select("host", "hash", F.col("first.text_hash").alias("first_text"))
    )
    gone = (
        held_lines.join(frequent, ["host", "hash"])
        .filter(F.col("text_hash") != F.col("first_text"))
        .groupBy("row")
        .agg(F.sum("words").alias("removed_words"), F.collect_set("hash").alias("removed"))
    )
    base_failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    left = F.col("n_words") - F.col("removed_words")
    return (
        found.drop("lines")
        .join(gone, "row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~base_failed & (100 * left >= LEAST_LEFT * F.col("n_words")))
        .drop("row")
    )


def without_lines(docs: DataFrame, verdicts: DataFrame, text: str, host: str) -> DataFrame:
    """The kept documents with all their columns and without their removed lines.
    A verdict depends on host and text alone, so they are the join key."""
    per_text = (
        verdicts.filter("kept")
        .groupBy("host", "text_hash")
        .agg(F.any_value("removed").alias("removed"))
    )
    whole = docs.select(
        F.struct("*").alias("doc"),
        host_of(host).alias("host"),
        text_hash_of(text).alias("text_hash"),
    )
    kept = whole.join(per_text, ["host", "text_hash"])
    strip = F.pandas_udf(strip_lines, T.StringType())
    changed = strip(F.col(f"doc.`{text}`"), F.col("removed"))
    return kept.withColumn("doc", F.col("doc").withField(f"`{text}`", changed)).select("doc.*")


def strip_lines(texts: pd.Series, removed: pd.Series) -> pd.Series:
    """Texts without the lines whose hashes are listed."""

    def strip(text, hashes):
        if hashes is None or not len(hashes):
            return text
        gone = {bytes(h) for h in hashes}
        lines = text.split("\n")
        kept = (x for x in lines if not (raw := x.encode()).split() or line_hash(raw) not in gone)
        return "\n".join(kept)

    return pd.Series([strip(t, h) for t, h in zip(texts, removed, strict=True)], dtype=object)
