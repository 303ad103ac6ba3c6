"""Landed JSON documents: one file per entity, the file name is the key."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.session import empty_table

LANDED = "file_name string, file_key string, body string"

# The years whose quarterly documents are wanted.
QUARTERLY_YEARS = (2022, 2023, 2024, 2025, 2026)


# White space of JSON, and the fields of a wrapped document.
JSON_SPACE = " \t\n\r"
FIELD, LAST_FIELD = "~document", "~end of document"


def document_value(body: Column) -> Column:
    """Compact text of the one JSON value of a document; null where the document
    is none, such as one that is cut off or goes on after its value.

    The value is parsed as a field before another, so both fields are there only
    if it is whole and alone.
    """
    wrapped = F.concat(F.lit('{"d":'), body, F.lit(f',"{LAST_FIELD}":1}}'))
    blank = F.trim(body, F.lit(JSON_SPACE)) == ""

    def value(fields: Column) -> Column:
        alone = (F.size(fields) == 2) & F.map_contains_key(fields, LAST_FIELD)
        return F.when(alone & ~blank, F.coalesce(F.get(F.map_values(fields), 0), F.lit("null")))

    # a lambda, so that the parsed fields are named several times and made once
    return F.get(F.transform(F.array(F.from_json(wrapped, "map<string,string>")), value), 0)


def document_status(body: Column) -> Column:
    """``data``, ``empty`` for an empty array, ``null``, ``failed`` for a document
    that records a fetch error, or ``unreadable``."""
    blank_null = F.trim(body, F.lit(JSON_SPACE)) == "null"
    failed = F.map_contains_key(F.from_json(body, "map<string,string>"), "_error")

    def status(value: Column) -> Column:
        return (
            F.when(value.isNull(), F.lit("unreadable"))
            .when(blank_null, F.lit("null"))
            .when(value == "[]", F.lit("empty"))
            .when(value.startswith("["), F.lit("data"))
            .when(value.startswith("{"), F.when(failed, F.lit("failed")).otherwise(F.lit("data")))
            .otherwise(F.lit("unreadable"))
        )

    return F.get(F.transform(F.array(document_value(body)), status), 0)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per JSON file of a folder.  A missing folder has no rows.

    Files are small and many, so each is read whole; write the result to
    Parquet once and shred from there.
    """
    try:
        files = (
            spark.read.format("text")
            .option("wholetext", True)
            .option("pathGlobFilter", "*.json")
            .load(folder)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, LANDED)
    return _named(files)


def _named(files: DataFrame) -> DataFrame:
    name = F.col("_metadata.file_name")
    return files.select(
        name.alias("file_name"),
        F.regexp_replace(name, r"\.json$", "").alias("file_key"),
        F.col("value").alias("body"),
    )


def document_stream(spark: SparkSession, folder: str) -> DataFrame:
    """JSON files of a folder, as they arrive."""
    files = (
        spark.readStream.format("text")
        .schema("value string")
        .option("wholetext", True)
        .option("pathGlobFilter", "*.json")
        .load(folder)
    )
    return _named(files)


def landed_stream(spark: SparkSession, table: str) -> DataFrame:
    """Rows of a landed Parquet table (see :mod:`dimflow.streaming.landing`), as they
    are added."""
    return spark.readStream.schema(LANDED).parquet(table)


def landed_table(spark: SparkSession, table: str) -> DataFrame | None:
    """Documents that :func:`dimflow.streaming.landing.land_new` has stored in a
    Parquet table; None for a table that is not there."""
    try:
        return spark.read.schema(LANDED).parquet(table)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_landed(spark: SparkSession, table: str) -> DataFrame:
    """As :func:`landed_table`; a table that is not there has no rows."""
    found = landed_table(spark, table)
    return empty_table(spark, LANDED) if found is None else found


def document_as(body: Column, kind: str) -> Column:
    """The one JSON value of a document as a value of type ``kind``; null where the
    document is no such value, or none at all, or more than one.

    The document is parsed once, as the only element of an array in a field before
    another field.  A text that is cut off breaks the whole; one that goes on after
    its value makes a second element or a third field, and a map keeps every field.
    """
    wrapped = F.concat(F.lit(f'{{"{FIELD}":['), body, F.lit(f'],"{LAST_FIELD}":[]}}'))
    fields = F.from_json(wrapped, f"map<string,array<{kind}>>")

    def alone(found: Column) -> Column:
        values = F.try_element_at(found, F.lit(FIELD))
        ended = F.size(F.try_element_at(found, F.lit(LAST_FIELD))) == 0
        return F.when((F.size(found) == 2) & ended & (F.size(values) == 1), F.get(values, 0))

    # a lambda, so that the parsed fields are named several times and made once
    return F.get(F.transform(F.array(fields), alone), 0)


def parse_objects(documents: DataFrame, schema: str) -> DataFrame:
    """Fields of the documents that hold one object; failed fetches, which carry
    an ``_error`` field, are left out."""
    shape = T.StructType.fromDDL(schema).add("_error", T.VariantType())
    one = F.array(document_as(F.col("body"), shape.simpleString()))
    found = _exploded(documents, one).filter(F.col("d._error").isNull())
    return found.select("file_name", "file_key", "d.*").drop("_error")


def parse_arrays(documents: DataFrame, schema: str) -> DataFrame:
    """Elements of the documents that hold an array, with their position."""
    elements = document_as(F.col("body"), T.ArrayType(T.StructType.fromDDL(schema)).simpleString())
    return _exploded(documents, elements).select("file_name", "file_key", "pos", "d.*")


def _exploded(documents: DataFrame, elements: Column) -> DataFrame:
    """The elements as column ``d``; those of null, broken or empty documents are
    left out.  The filter sits behind the generator and names only its output, so
    Spark cannot copy the parser into it."""
    rows = documents.select("file_name", "file_key", F.posexplode_outer(elements).alias("pos", "d"))
    return rows.filter(F.col("d").isNotNull())


def composite_key(file_key: Column) -> tuple[Column, Column]:
    """``"1887_2026"`` as the entity id 1887 and the period 2026."""
    part = r"^(\d+)_(\d+)$"
    return (
        F.regexp_extract(file_key, part, 1).try_cast("int"),
        F.regexp_extract(file_key, part, 2).try_cast("int"),
    )


def expected_keys(ids: DataFrame, periods: list, out: str) -> DataFrame:
    """Every id with every period of a short list, such as years."""
    return ids.withColumn(out, F.explode(F.array(*[F.lit(p) for p in periods])))


def pending(wanted: DataFrame, landed: DataFrame, key: list[str], force: bool = False) -> DataFrame:
    """Wanted keys that have not landed yet; all of them when forced."""
    return wanted if force else wanted.join(landed.select(*key), key, "left_anti")


def landing_status(documents: DataFrame, source: Column) -> DataFrame:
    """Number of documents per source and status."""
    status = document_status(F.col("body")).alias("status")
    stated = documents.select(source.alias("source"), status)
    return stated.groupBy("source", "status").agg(F.count("*").alias("n_documents"))


def first_entities(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` entities in order, for a trial run on a subset."""
    return df.orderBy(*order).limit(n)


def of_entities(children: DataFrame, key: str, entities: DataFrame) -> DataFrame:
    return children.join(entities.select(key), key, "left_semi")


def in_range(df: DataFrame, day: str, first, last) -> DataFrame:
    """Rows from ``first`` to ``last``, both included."""
    return df.filter(F.col(day).between(F.lit(first), F.lit(last)))
