"""The log of attempts to land documents.

Every run adds one row per wanted key: what became of it.  Nothing is ever changed
in the log, so the state of a key is that of its newest attempt that was made.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.session import empty_table
from dimflow.sources.documents import document_status

ATTEMPTS = "source string, file_key string, run string, attempted_at timestamp, outcome string"
KEY = ["source", "file_key"]
SKIPPED, MISSING = "skipped", "missing"


def outcome(body: Column) -> Column:
    """``fetched``, ``empty`` for an answer without data, or ``failed``."""
    status = document_status(body)
    return (
        F.when(status == "data", F.lit("fetched"))
        .when(status.isin("empty", "null"), F.lit("empty"))
        .otherwise(F.lit("failed"))
    )


def read_attempts(spark: SparkSession, log: str) -> DataFrame:
    try:
        return spark.read.schema(ATTEMPTS).parquet(log)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, ATTEMPTS)


def newest_states(attempts: DataFrame) -> DataFrame:
    """The outcome of the newest attempt per key, without those that were skipped.
    Attempts are combined before the shuffle, so a key of many runs is no hot key."""
    made = attempts.filter(F.col("outcome") != SKIPPED)
    order = F.struct("attempted_at", "run")
    return made.groupBy(*KEY).agg(
        F.max("attempted_at").alias("attempted_at"), F.max_by("outcome", order).alias("outcome")
    )


def to_attempt(wanted: DataFrame, attempts: DataFrame, force: bool = False, retry: bool = False) -> DataFrame:
    """Wanted keys that a run has to fetch: those without an attempt, with ``retry``
    also those whose newest attempt failed, with ``force`` all."""
    if force:
        return wanted
    done = newest_states(attempts)
    if retry:
        done = done.filter(~F.col("outcome").isin("failed", MISSING))
    return wanted.join(done.select(*KEY), KEY, "left_anti")


def attempts_of_run(
    wanted: DataFrame, due: DataFrame, documents: DataFrame, run: str, at: datetime
) -> DataFrame:
    """One attempt per wanted key: ``skipped`` if it was not due, else the outcome of
    its document, or ``missing`` if none has landed."""
    told = documents.select(*KEY, outcome(F.col("body")).alias("_told")).dropDuplicates(KEY)
    keys = wanted.select(*KEY).distinct()
    due = due.select(*KEY, F.lit(True).alias("_due")).distinct()
    found = F.when(F.col("_due"), F.coalesce("_told", F.lit(MISSING))).otherwise(F.lit(SKIPPED))
    return keys.join(due, KEY, "left").join(told, KEY, "left").select(
        *KEY,
        F.lit(run).alias("run"),
        F.lit(at).cast("timestamp").alias("attempted_at"),
        found.alias("outcome"),
    )


def record_run(
    wanted: DataFrame,
    documents: DataFrame,
    log: str,
    run: str,
    at: datetime,
    force: bool = False,
    retry: bool = False,
) -> None:
    """Add the attempts of a run to the log; a run that is in the log is not added
    again."""
    known = read_attempts(wanted.sparkSession, log)
    if not known.filter(F.col("run") == run).isEmpty():
        return
    due = to_attempt(wanted, known, force, retry)
    attempts_of_run(wanted, due, documents, run, at).write.mode("append").parquet(log)


def attempt_counts(attempts: DataFrame) -> DataFrame:
    """Number of keys per run, source and outcome."""
    return attempts.groupBy("run", "source", "outcome").agg(F.count("*").alias("n_keys"))
