"""Registry and readers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SCHEMAS: dict[tuple, T.StructType] = {}  # by path and time of change, from its footer


class Tables:
    """Tables of one scale folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self._folder}/{name}.parquet"
        file = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        status = file.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(file)
        version = (path, status.getModificationTime())
        if version not in SCHEMAS:
            SCHEMAS[version] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[version]).parquet(path)


def query(sql: str | None = None):
    """Register a function of :class:`Tables` under its name, with its SQL."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def rounded(column: str, digits: int = 6):
    return F.round(F.col(column).cast("double"), digits).alias(column)


def cents(column: str):
    """A money amount as an exact decimal, so sums do not depend on row order."""
    return F.round(F.col(column), 2).cast("decimal(18,2)")


def day(column: str):
    return F.col(column).cast("date")
