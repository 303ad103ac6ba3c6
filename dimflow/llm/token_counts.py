"""Token counts of documents behind a cache of digests.

The cache is a Parquet folder with one row per tokenizer version and content:

    tokenizer      digest of the vocabulary file and of the library that reads it
                   (a folder of its own, so other versions are never read)
    digest         digest of the normalised content
    n_tokens       its count

A run joins the digests of its documents to the stored counts, encodes one text
of each digest that is missing, appends these counts and joins all counts back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.storage import Stored
from dimflow.llm.tokens import Encoder, slices

CACHE_SCHEMA = "digest binary, n_tokens bigint, tokenizer string"
#: At most so many missing digests (32 bytes each) are broadcast to pick their
#: texts; of more, the texts are shuffled by digest.
BROADCAST_DIGESTS = 100_000


def tokenizer_digest(path: str) -> str:
    """Names a tokenizer: the bytes of its file and the version of its library."""
    library = sentencepiece if path.endswith(".model") else tokenizers
    name = f"{library.__name__} {library.__version__}\n".encode()
    return hashlib.sha256(name + Path(path).read_bytes()).hexdigest()


class Counter:
    """Numbers of ids, as the library of the vocabulary file gives them."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            self._pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.count = self._count_pieces
        else:
            self.count = Encoder(path).count

    def _count_pieces(self, texts: pa.Array) -> np.ndarray:
        encoded = self._pieces.encode([t or "" for t in texts.to_pylist()], num_threads=1)
        return np.fromiter(map(len, encoded), np.int64, len(encoded))


def content(text: Column) -> Column:
    """What is counted of a text.  Both libraries count every byte of it, so the
    only texts that are sure to count alike are equal ones; null counts as empty."""
    return F.coalesce(text, F.lit(""))


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(content(text), 256))


def once(texts: DataFrame) -> DataFrame:
    """One text of each digest; copies meet within a task before they are shuffled."""
    return texts.groupBy("digest").agg(F.first("text").alias("text"))


def encode_misses(texts: DataFrame, tokenizer: str) -> DataFrame:
    """``digest`` and ``n_tokens`` of each row of ``digest`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                counts = pa.array(counter.count(part.column("text")), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), counts], names=["digest", "n_tokens"]
                )

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens bigint")


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The stored counts of one tokenizer, one row per digest.  Two runs at a time
    may both append a count, and the two are equal."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "digest binary, n_tokens bigint")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    stored = stored.filter(F.col("tokenizer") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, held: Stored, limit: int = 1024,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``key``, ``digest``, ``n_bytes``, ``n_tokens``, ``over_limit`` and ``cached``
    (whether the count was stored before this run) of every row.

    ``tokenizer`` is a .json file of the tokenizers library or a .model file of
    sentencepiece, at a path that every executor has; no begin, end or added
    special tokens, no truncation.  ``cache`` is a folder that is made where it
    is missing.  A null text counts as empty and has the count of the empty text.
    Texts are counted whole, however long; a task holds some megabytes of texts,
    or one longer text, at a time.  Repeated rows and null keys are rows of their
    own; copies of a text are encoded once.  Columns other than the two are
    ignored whatever they are named.  An empty table gives no rows and appends
    nothing.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer)
    rows = docs.select(F.col(key).alias("key"), content(F.col(text)).alias("text"))
    rows = rows.select("key", digest_of(F.col("text")).alias("digest"), "text")
    narrow = held.keep(rows.select("key", "digest", F.octet_length("text").cast("bigint").alias("n_bytes")))
    wanted = narrow.select("digest").distinct()
    looked = held.keep(wanted.join(read_cache(spark, cache, version), "digest", "left"))
    misses = looked.filter("n_tokens IS NULL").select("digest")
    texts = rows.select("digest", "text")
    if misses.count() <= BROADCAST_DIGESTS:
        texts = once(texts.join(F.broadcast(misses), "digest"))
    else:
        texts = once(texts).join(misses, "digest")
    fresh = held.keep(encode_misses(texts, tokenizer))
    fresh.withColumn("tokenizer", F.lit(version)).write.partitionBy("tokenizer").mode("append").parquet(cache)
    hits = looked.filter("n_tokens IS NOT NULL")
    counts = held.keep(
        hits.withColumn("cached", F.lit(True)).unionByName(fresh.withColumn("cached", F.lit(False)))
    )
    return narrow.join(counts, "digest").select(
        "key", "digest", "n_bytes", "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"), "cached",
    )
