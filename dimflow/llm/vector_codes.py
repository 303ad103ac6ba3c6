"""Product codes of vectors: each part of a vector becomes the index of the nearest
entry of that part's codebook.

Vectors are taken as they lie in the partitions, in chunks of bounded size.  Every
chunk gets one metric tree per part (``metric_tree``), built once and stored.  A
round sends the codebooks to the trees; what comes back is a count and a sum per
entry, added up within each task and then over all.  No vector is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.metric_tree import Tree
from dimflow.llm.storage import Stored

MOST = 2.0**27  # scaled components beyond this count as it, so that errors fit 64 bits
CHUNK = 16_384  # vectors
CHUNK_BYTES = 8 << 20
ONE = np.dtype("<i4")

TREES_SCHEMA = "keys array<bigint>, labels array<string>, trees array<binary>"
SUMS_SCHEMA = "part int, entry int, place int, total bigint"
CODES_SCHEMA = "key bigint, label string, code string, error bigint"


def pack_whole(vectors: DataFrame, key: str, label: str, vector: str, scale: float) -> DataFrame:
    """Key, label and the floors of the scaled components of each usable vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan))
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            broken = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            used = np.flatnonzero((sizes > 0) & (broken[ends] == broken[ends - sizes]))
            with np.errstate(over="ignore", invalid="ignore"):
                floors = np.floor(np.clip(scale * flat, -MOST, MOST))
            raw = np.where(np.isfinite(floors), floors, 0).astype(ONE).tobytes()
            packed = [
                raw[4 * a : 4 * b]
                for a, b in zip((ends - sizes)[used].tolist(), ends[used].tolist(), strict=True)
            ]
            chosen = batch.select(["key", "label"]).take(pa.array(used))
            yield pa.RecordBatch.from_arrays(
                [*chosen.columns, pa.array(packed, pa.binary())], names=["key", "label", "packed"]
            )

    chosen = vectors.select(
        F.col(key).cast("bigint").alias("key"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return chosen.mapInArrow(run, "key bigint, label string, packed binary")


def build_trees(packed: DataFrame, parts: int) -> DataFrame:
    """One row per chunk: keys, labels and the tree of each part."""

    def chunk(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        raw = b"".join(table.column("packed").to_pylist())
        whole = np.frombuffer(raw, ONE).reshape(table.num_rows, -1)
        trees = [Tree.build(part).to_bytes() for part in np.split(whole, parts, axis=1)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([table.column("key").to_pylist()], pa.list_(pa.int64())),
                pa.array([table.column("label").to_pylist()], pa.list_(pa.string())),
                pa.array([trees], pa.list_(pa.binary())),
            ],
            names=["keys", "labels", "trees"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, most = [], 0, CHUNK
        for batch in batches:
            while batch.num_rows:
                most = max(1, min(CHUNK, CHUNK_BYTES // len(batch.column("packed")[0].as_py())))
                some = batch.slice(0, most - n)
                batch = batch.slice(some.num_rows)
                held.append(some)
                n += some.num_rows
                if n == most:
                    yield chunk(held)
                    held, n = [], 0
        if held:
            yield chunk(held)

    return packed.select("key", "label", "packed").mapInArrow(run, TREES_SCHEMA)


def next_books(trees: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every entry replaced by the floor of the mean of the parts nearest to it.
    The driver gets one number per component of an entry, the size of the books."""
    parts, entries = len(books), len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = books[0].shape[1]
        sums = np.zeros((parts, entries, 1 + width), np.int64)  # the count comes first
        for batch in batches:
            for row in batch.column("trees"):
                for part, raw in enumerate(row.as_py()):
                    _, counts, totals = Tree.from_bytes(raw).nearest(books[part])
                    sums[part, :, 0] += counts
                    sums[part, :, 1:] += totals
        part, entry, place = (x.reshape(-1).astype(np.int32) for x in np.indices(sums.shape))
        used = np.repeat(sums[:, :, :1] > 0, 1 + width, axis=2).reshape(-1)
        columns = [pa.array(x[used]) for x in (part, entry, place, sums.reshape(-1))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "place", "total"])

    summed = trees.select("trees").mapInArrow(run, SUMS_SCHEMA)
    rows = summed.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).toArrow()
    part, entry, place, total = (np.asarray(c.combine_chunks()).astype(np.int64) for c in rows.columns)
    sums = np.zeros((parts, entries, 1 + books[0].shape[1]), np.int64)
    sums[part, entry, place] = total
    counts = sums[:, :, :1]
    means = sums[:, :, 1:] // np.maximum(counts, 1)
    return [np.where(counts[p] > 0, means[p], books[p]) for p in range(parts)]


def assign(trees: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Key, label, code and error of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = batch.column("keys")[i].values
                codes = np.zeros((len(keys), len(books)), np.uint8)
                error = np.zeros(len(keys), np.int64)
                for part, raw in enumerate(batch.column("trees")[i].as_py()):
                    tree = Tree.from_bytes(raw)
                    nearest, _, _ = tree.nearest(books[part])
                    codes[tree.place, part] = nearest
                    missed = tree.points.astype(np.int64) - books[part][nearest]
                    error[tree.place] += np.square(missed).sum(axis=1)
                text = codes.tobytes().hex()
                width = 2 * len(books)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys, batch.column("labels")[i].values,
                        pa.array([text[a : a + width] for a in range(0, len(text), width)]), pa.array(error),
                    ],
                    names=["key", "label", "code", "error"],
                )

    return trees.mapInArrow(run, CODES_SCHEMA)


def first_books(packed: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest keys, of the length of the first one
    that can be cut.  Equal keys are ordered by their components' bytes, null ones
    come last."""
    order = [F.asc_nulls_last("key"), "packed"]
    fitting = packed.filter(F.octet_length("packed") % (ONE.itemsize * parts) == 0).orderBy(*order)
    first = fitting.select("packed").first()
    if first is None:
        return []
    size = len(first["packed"])
    start = packed.filter(F.octet_length("packed") == size).orderBy(*order).limit(entries)
    raw = b"".join(r["packed"] for r in start.select("packed").collect())
    whole = np.frombuffer(raw, ONE).reshape(-1, size // ONE.itemsize).astype(np.int64)
    return np.split(whole, parts, axis=1)


def compress(
    vectors: DataFrame, held: Stored, scale: float = 1024, parts: int = 4, entries: int = 256,
    rounds: int = 4, key: str = "vec_id", label: str = "label", vector: str = "embedding",
) -> tuple[DataFrame, list[np.ndarray]]:
    """``key``, ``label`` (as text), ``code`` (two hex digits for each part) and
    ``error`` of every vector, and the codebooks, an array per part.

    A component counts as the floor of ``scale`` times it, held to 2**27 either way.
    The codebook of a part starts as that part of the ``entries`` (256 at most)
    vectors with the smallest keys; each round assigns every part to its nearest entry
    by squared distance, the lower index on ties, and replaces the entries that own
    parts by the floors of their means.  ``error`` is the squared distance to the
    final entries, summed over the parts.

    A vector that is null or empty or has a null or non-finite component gives no row,
    nor does one of another length than the first vector, by key, that can be cut into
    ``parts``.  Null and repeated keys and repeated rows are vectors of their own, null
    keys come last.  With fewer than ``entries`` vectors the codebooks are shorter.
    Other columns are ignored.  An empty table gives no rows and no codebooks.
    """
    packed = held.keep(pack_whole(vectors, key, label, vector, scale))
    books = first_books(packed, parts, entries)
    if not books:
        return vectors.sparkSession.createDataFrame([], CODES_SCHEMA), []
    size = ONE.itemsize * parts * books[0].shape[1]
    trees = held.keep(build_trees(packed.filter(F.octet_length("packed") == size), parts))
    for _ in range(rounds):
        books = next_books(trees, books)
    return held.keep(assign(trees, books)), books


def label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the errors summed over equal labels, nulls
    together, at most the greatest bigint.  The sums are combined within tasks, so a
    label of many rows is no hot key."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)"))
    sums = codes.groupBy(F.col("label").alias("of")).agg(total.cast("bigint").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def books_digest(books: list[np.ndarray]) -> str:
    """Of all components in decimal, by part, entry and place, joined by commas."""
    numbers = (str(x) for book in books for x in book.reshape(-1).tolist())
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress_sql(rounds: int = 4) -> str:
    """DuckDB SQL for the codes of the table ``embeddings`` in four parts, by distances
    to all entries, with the errors by label and the digest of the codebooks."""
    steps = [
        """kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
                list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings WHERE embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        )""",
        """parts AS MATERIALIZED (
            SELECT r, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS x FROM kept, range(4) t(p)
        )""",
        "book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= 256)",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (
            SELECT r, p, any_value(x) AS x, min(struct_pack(d := list_inner_product(x, x)
                - 2 * list_inner_product(x, c) + list_inner_product(c, c), e := e)) AS m
            FROM parts JOIN book{k} USING (p) GROUP BY r, p
        )"""
        )
        if k < rounds:
            steps.append(
                f"""book{k + 1} AS MATERIALIZED (
            WITH mean AS (
                SELECT p, e, list(floor(s / n) ORDER BY i) AS c FROM (
                    SELECT p, m.e AS e, i, sum(x[i]) AS s, count(*) AS n
                    FROM (SELECT p, m, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY ALL
                ) GROUP BY p, e
            )
            SELECT p, e, coalesce(mean.c, old.c) AS c FROM book{k} old LEFT JOIN mean USING (p, e)
        )"""
            )
    steps += [
        f"""coded AS (
            SELECT r, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error
            FROM near{rounds} GROUP BY r
        )""",
        f"""books AS (
            SELECT sha256(string_agg(c[i]::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
            FROM (SELECT p, e, c, unnest(range(1, len(c) + 1)) AS i FROM book{rounds})
        )""",
    ]
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            codebooks_sha256
        FROM kept JOIN coded USING (r), books"""
