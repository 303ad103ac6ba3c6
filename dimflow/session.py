"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("dimflow")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names; all executors reach it.
    A local session without one gets a temporary folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="dimflow-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the stored
    rows.  Unlike an RDD checkpoint this computes ``df`` once, and the planner
    knows the size of what it reads back."""
    folder = f"{shared_folder(df.sparkSession)}/{uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


ROW_BYTES = 256  # of the broadcast threshold that a row counts for


def fits_broadcast(spark: SparkSession, rows: int) -> bool:
    """Whether the session's threshold lets a side of so many rows be broadcast.

    The planner knows no rows: it takes the size of compressed files, shared out over
    the columns by their types, which can be a hundredth of what the rows take when
    the driver gathers and hashes them."""
    return rows * ROW_BYTES <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def shuffle_long(df: DataFrame, rows: int) -> DataFrame:
    """A side of a join that has ``rows`` rows, or is known to have no more: joined by
    a shuffle where these are too many to be broadcast, else as the planner likes."""
    return df if fits_broadcast(df.sparkSession, rows) else df.hint("merge")


def lookup(df: DataFrame, rows: int) -> DataFrame:
    """As :func:`shuffle_long`, for narrow rows that a longer side looks up: broadcast
    where they are few, so that the planner cannot choose the longer side."""
    return F.broadcast(df) if fits_broadcast(df.sparkSession, rows) else df.hint("merge")


def run_together(jobs: list, workers: int = 8) -> list:
    """Run independent writes at the same time, so that small tables fill the
    executors a large one leaves idle.  The first failure is raised."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows, in a form that lets the optimizer drop joins with it."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return spark.range(1).filter(F.lit(False)).select(*columns)
