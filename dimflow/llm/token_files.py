"""Token files: frequency-ranked ids in a byte-aligned variable-length code.

Ids are replaced by their rank of frequency in the whole corpus, so the common
ones fit one byte.  A rank takes one to four bytes; the lengths, two bits each,
stand apart in control bytes, so a reader finds all places by one table lookup
per control byte and a running sum.

Files are Parquet, one row per block of whole documents with the columns

    part, block    place of the block: files are in ascending key order
    first          ids before the block in its part
    keys, counts   key and number of ids of each document
    control, data  the two streams

so Spark's commit makes a file visible whole, on any file system Spark writes.
The rank table lies beside them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.storage import drop_folder, new_folder
from dimflow.llm.tokens import Encoder, slices

BLOCK_IDS = 1 << 20
#: Bytes of the four values of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)

BLOCK_SCHEMA = (
    "part int, block int, first bigint, keys array<bigint>, counts array<bigint>, "
    "control binary, data binary"
)


def encode_block(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    size = 1 + (values > 0xFF) + (values > 0xFFFF) + (values > 0xFFFFFF)
    spread = values.view(np.uint8).reshape(-1, 4)
    data = spread[np.arange(4) < size[:, None]].tobytes()
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = size - 1
    fours = codes.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data


def decode_block(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of a block."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(size, dtype=np.int64)
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    words = np.ndarray((max(len(padded) - 3, 0),), "<u4", padded, strides=(1,))
    return words[ends - size] & MASKS[size]


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, key: str, text: str) -> DataFrame:
    """Key, number of ids and ids of each document, in as many bytes as the vocabulary
    needs; and after the documents of each task, a row without ids for every id that
    the task has seen, as ``key``, with its count, as ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, kind = Encoder(tokenizer), id_type(tokenizer, end_id)
        seen = np.zeros(max(encoder.size, end_id + 1), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                flat, counts = encoder.encode(part.column("text"))
                ids = np.insert(flat.astype(kind), np.cumsum(counts), end_id)
                seen += np.bincount(ids, minlength=len(seen))
                bounds = np.concatenate([[0], np.cumsum(counts + 1)]) * ids.itemsize
                raw = pa.Array.from_buffers(
                    pa.large_binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(ids)]
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(counts + 1), raw.cast(pa.binary())],
                    names=["key", "n", "ids"],
                )
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(seen[used]), pa.nulls(len(used), pa.binary())],
            names=["key", "n", "ids"],
        )

    chosen = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "key bigint, n bigint, ids binary")


@cache
def id_type(tokenizer: str, end_id: int) -> np.dtype:
    size = max(Encoder(tokenizer).size, end_id + 1)
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


def frequency_ranks(tokens: DataFrame) -> list[int]:
    """The ids that occur, by their count over all documents, the most frequent
    first.  What reaches the driver is bounded by the vocabulary."""
    counted = tokens.filter("ids IS NULL").groupBy("key").agg(F.sum("n").alias("n")).collect()
    return [r["key"] for r in sorted(counted, key=lambda r: (-r["n"], r["key"]))]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2,
    key: str = "doc_id", text: str = "text",
) -> None:
    """Write the ids of all documents to ``folder`` in ascending key order.

    Each document's ids end with ``end_id``; a null or empty text gives that id
    alone.  Rows with one key follow each other in the order of a hash of their ids,
    and may lie in several parts; a null key comes first.  Other columns are
    ignored.  An empty table gives files without blocks.
    """
    spark = docs.sparkSession
    held = new_folder(spark)
    encode_documents(docs, tokenizer, end_id, key, text).write.option(
        "compression", "zstd"
    ).parquet(held)
    tokens = spark.read.parquet(held)
    ranked = frequency_ranks(tokens)
    ranks = np.zeros(max(ranked, default=0) + 1, "<u4")
    ranks[ranked] = np.arange(len(ranked))
    kind = id_type(tokenizer, end_id)
    pairs = [(i, rank) for rank, i in enumerate(ranked)]
    spark.createDataFrame(pairs, "id bigint, rank bigint").coalesce(1).write.parquet(f"{folder}/ranks")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first = TaskContext.get().partitionId(), 0, 0
        keys, counts, ids, held_ids = [], [], [], 0

        def close():
            nonlocal number, first, held_ids
            control, data = encode_block(ranks[np.concatenate(ids)])
            row = {
                "part": part, "block": number, "first": first, "keys": list(keys),
                "counts": list(counts), "control": control, "data": data,
            }
            number, first, held_ids = number + 1, first + held_ids, 0
            for held_list in (keys, counts, ids):
                held_list.clear()
            return pa.RecordBatch.from_pylist([row], schema=BLOCK_FIELDS)

        for batch in batches:
            for k, n, packed in zip(*map(pa.Array.to_pylist, batch.columns), strict=True):
                keys.append(k)
                counts.append(n)
                ids.append(np.frombuffer(packed, kind))
                held_ids += n
                if held_ids >= BLOCK_IDS:
                    yield close()
        if keys:
            yield close()

    # rows of one key are told apart by their ids, equal ones by their place
    order = ["key", "hash", "place"]
    in_order = (
        tokens.filter("ids IS NOT NULL")
        .withColumns({"hash": F.xxhash64("ids"), "place": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    in_order.select("key", "n", "ids").mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(
        f"{folder}/blocks"
    )
    drop_folder(spark, held)


BLOCK_FIELDS = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()),
        ("keys", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
        ("control", pa.binary()), ("data", pa.binary()),
    ]
)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents from token files: key, ids before it, number of ids and the ids
    as little-endian unsigned 32-bit integers.  The driver holds one number per
    file and the rank table, which the vocabulary bounds."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    sizes = blocks.groupBy("part").agg(F.sum(total).alias("n")).collect()
    base, before = {}, 0
    for row in sorted(sizes):
        base[row["part"]] = before
        before += row["n"]
    ranked = spark.read.parquet(f"{folder}/ranks").collect()
    ids_of = np.array([r["id"] for r in sorted(ranked, key=lambda r: r["rank"])], "<u4")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ends = np.cumsum(counts)
                ids = ids_of[decode_block(row["control"], row["data"], int(ends[-1]))].tobytes()
                starts = base[row["part"]] + row["first"] + ends - counts
                each = [ids[4 * a : 4 * b] for a, b in zip(ends - counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["keys"], pa.int64()), pa.array(starts), pa.array(counts),
                        pa.array(each, pa.binary()),
                    ],
                    names=["key", "start", "n_tokens", "ids"],
                )

    return blocks.mapInArrow(documents, "key bigint, start bigint, n_tokens bigint, ids binary")
