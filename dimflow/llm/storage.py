"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from dimflow.session import shared_folder


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate table once nothing reads it any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Stored:
    """Tables that a job writes to the shared folder and drops when it is done.

    ``keep`` cuts the lineage of a table: what follows reads the stored rows, so
    a lost executor recomputes nothing that came before.  On leaving the block
    every table but those marked ``last`` is deleted.
    """

    def __init__(self, spark: SparkSession):
        self._spark, self._folders, self._tables = spark, [], []

    def keep(self, df: DataFrame, last: bool = False, **options: str) -> DataFrame:
        folder = new_folder(self._spark)
        df.write.options(**options).parquet(folder)
        if not last:
            self._folders.append(folder)
        return self._spark.read.schema(df.schema).parquet(folder)

    def folder(self) -> str:
        """The name of a folder that is dropped with the tables."""
        self._folders.append(new_folder(self._spark))
        return self._folders[-1]

    def keep_bucketed(self, df: DataFrame, buckets: int, by: str) -> DataFrame:
        """Like ``keep``, in buckets, so that joins on ``by`` do not shuffle it."""
        folder, table = new_folder(self._spark), f"stored_{uuid4().hex}"
        options = {"path": folder, "compression": "none"}
        df.write.bucketBy(buckets, by).options(**options).saveAsTable(table)
        self._folders.append(folder)
        self._tables.append(table)
        return self._spark.table(table)

    def __enter__(self) -> Stored:
        return self

    def __exit__(self, *_) -> None:
        for table in self._tables:
            self._spark.sql(f"DROP TABLE IF EXISTS {table}")
        for folder in self._folders:
            drop_folder(self._spark, folder)
