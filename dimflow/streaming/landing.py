"""Landing only what is new.

The file source of Structured Streaming remembers the files it has read, so a
run takes the documents that have arrived since the last one and stops.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from dimflow.sources.documents import document_stream


def land_new(spark: SparkSession, folder: str, landed: str, progress: str) -> None:
    """Append the new documents of ``folder`` to the Parquet table ``landed``.

    ``progress`` keeps the list of files already taken.  A second run without
    new files does nothing, and a failed run is taken up where it stopped.
    """
    documents = document_stream(spark, folder)
    (
        documents.writeStream.format("parquet")
        .option("path", landed)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
