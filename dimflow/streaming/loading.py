"""Landed documents into the published tables, batch by batch.

Structured Streaming hands every batch of new documents to :func:`load_batch`, which
shreds it and merges it under the table contracts.  The line that publishes a batch
also says that this batch of the stream is done, so a batch that is handed over again
after a failure either was published whole and is skipped, or has left no trace and
is loaded.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from dimflow.plans.load import load
from dimflow.plans.transform import Clean, transform_documents
from dimflow.sources.published import Published


def load_batch(
    documents: DataFrame,
    number: int,
    *,
    stream: str,
    source: str,
    work: str,
    root: str,
    batch_ts: datetime,
    rating_field: str | None = None,
) -> bool:
    """Load batch ``number`` of ``stream``, whose documents are of folder ``source``;
    False where it was loaded before.  Batches are numbered upwards, and one is
    loaded at a time."""
    published = Published(documents.sparkSession, root)
    if number <= published.streams.get(stream, -1):
        return False
    batch = f"{stream}-{number:08d}"
    clean = Clean(documents.sparkSession, f"{work.rstrip('/')}/{batch}")
    valid = published.read_side("mutual_fund").select("fund_id")
    names = transform_documents(documents, source, clean, valid, rating_field)
    load(published, clean, names, batch, batch_ts)
    published.publish(batch, stream, number)
    return True


def load_stream(documents: DataFrame, progress: str, **options) -> None:
    """Load all that has arrived in ``documents``, a stream, and stop.  ``progress``
    keeps what was taken; the options are those of :func:`load_batch`.  A stream has
    one progress folder for good, as its batches are numbered there."""

    def take(batch: DataFrame, number: int) -> None:
        load_batch(batch, number, **options)

    (
        documents.writeStream.foreachBatch(take)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
