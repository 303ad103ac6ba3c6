"""The corpus pipeline: stages that each apply one operator to what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm import langid, packing, quality, simhash, suffixes
from dimflow.llm.queries import BYTE_BPE
from dimflow.llm.storage import Stored, new_folder

LEAST_SCORE = 0.5  # of a predicted language

#: SQL cannot express byte context trees, suffix sorting and packing by a vocabulary.
ORACLE_SQL = None


def with_length(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines these remove."""
    with Stored(spark) as held:
        verdicts = held.keep(quality.judge(docs, held))
        kept = quality.without_lines(docs, verdicts, "text", "source")
        return held.keep(with_length(kept), last=True)


def filter_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the trees of the labelled texts recognise."""
    model = langid.train(docs.filter(~langid.held_out("doc_id")), "text", "lang")
    whole = docs.select(F.struct("*").alias("doc"), "text")
    found = langid.predict(whole, model, key="doc")
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.filter(known).select("key.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the lowest id, and of rows
    with one id the lowest text hash, once."""
    name = F.struct(
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"),
        F.md5(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    with Stored(spark) as held:
        found = simhash.near_duplicates(
            docs.select(name.alias("name"), "text"), held, shingle=3, radius=3, key="name"
        )
        chosen = held.keep(found.filter("key = component").select("key.*").distinct())
        named = docs.select(F.struct("*").alias("doc"), name.alias("name")).select("doc", "name.*")
        kept = named.join(chosen, ["id", "text_hash"], "left_semi")
        # repeated rows share id and hash: keep one, where the join has put them together
        once = kept.groupBy("id", "text_hash").agg(F.any_value("doc").alias("doc"))
        return held.keep(once.select("doc.*"), last=True)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the strings of 200 bytes that start at two
    places or more.  What a cut leaves of a divided character becomes U+FFFD."""
    with Stored(spark) as held:
        found = suffixes.remove_repeats(docs, held, span=200)
        text = F.make_valid_utf8(F.col("kept").cast("string"))
        columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
        return held.keep(with_length(found.withColumn("text", text).select(*columns)), last=True)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their ids."""
    pieces = packing.pack(docs, BYTE_BPE, length=1024, end_id=0)
    return pieces.select(
        F.col("key").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "ids",
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", filter_quality),
    ("language id", filter_language),
    ("simhash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", drop_repeated_strings),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.  Each result is written to the
    shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        folder = new_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
