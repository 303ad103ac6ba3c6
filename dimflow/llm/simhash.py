"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits are joined through a value in the middle:
each emits all variants within half the radius, and a pair that is near enough
meets at one of them.  An odd radius is made even first: of several blocks of
bits, at least one holds a differing bit of the pair, so leaving each block out
in turn leaves an even radius for the rest.  With radius 3 and three blocks a
fingerprint emits 131 variants of about 43 bits.

Only distinct fingerprints take part, so copies cost one row each.  Variants are
shuffled and sorted; a task reads them as a stream and holds the fingerprints of
one variant, whose number the left-out bits bound and not the corpus.  All pairs
at a variant are verified in 64 bits, and of the links found there a spanning
forest goes on, so a dense group sends no more links than it has members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.components import components
from dimflow.llm.storage import Stored
from dimflow.llm.tokens import slices

BITS = 64
SEED = 42
BLOCKS = 3
WHITE = b" \t\n\v\f\r"


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the word shingles of a text, as an unsigned number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    take = min(shingle, len(words))
    spans = zip(starts[: len(words) - take + 1].tolist(), ends[take - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], ">u8")
    ones = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[a : a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """Key and fingerprint (as a signed 64-bit number) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                found = [fingerprint(t or b"", shingle) for t in texts]
                signed = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), pa.array(signed)], names=["key", "print"]
                )

    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([chosen.schema["key"], T.StructField("print", T.LongType())])
    return chosen.mapInArrow(run, schema)


def masks(radius: int) -> list[tuple[int, int]]:
    """Pairs (bits kept, bits flipped) that make the variants of a fingerprint.

    The left-out block, zero in all variants, carries its number, so variants of
    different blocks never meet.
    """
    whole = (1 << BITS) - 1
    if radius % 2 == 0:
        kept = [(whole, 0)]
    else:
        cuts = [BITS * b // BLOCKS for b in range(BLOCKS + 1)]
        kept = [
            (whole ^ ((1 << z) - (1 << a)), number << a)
            for number, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False))
        ]
    found = []
    for keep, tag in kept:
        bits = [1 << b for b in range(BITS) if keep >> b & 1]
        for size in range(radius // 2 + 1):
            found += [(keep, tag | sum(flips)) for flips in combinations(bits, size)]
    return found


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def near_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links that connect every two of the distinct ``prints`` within ``radius``
    bits, directly or by way of others that are; each is verified."""
    both = masks(radius)
    keep = F.array(*[F.lit(signed(k)) for k, _ in both])
    flip = F.array(*[F.lit(signed(f)) for _, f in both])
    variants = prints.select(
        "print", F.explode(F.sequence(F.lit(0), F.lit(len(both) - 1))).alias("i")
    ).select(
        F.get(keep, F.col("i")).bitwiseAND(F.col("print")).bitwiseXOR(F.get(flip, F.col("i"))).alias("at"),
        "print",
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = prints = np.empty(0, np.int64)
        for batch in batches:
            at = np.concatenate([at, np.asarray(batch.column("at"))])
            prints = np.concatenate([prints, np.asarray(batch.column("print"))])
            if at[0] == at[-1]:
                continue  # one variant so far
            whole = int(np.searchsorted(at, at[-1]))  # the last variant may go on
            yield links_batch(at[:whole], prints[:whole], radius)
            at, prints = at[whole:], prints[whole:]
        if len(at):
            yield links_batch(at, prints, radius)

    met = variants.repartition("at").sortWithinPartitions("at")
    return met.mapInArrow(meet, "a bigint, b bigint").distinct()


def links_batch(at: np.ndarray, prints: np.ndarray, radius: int) -> pa.RecordBatch:
    """Verified links among the prints of each variant; ``at`` is sorted."""
    prints = prints.view(np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    sizes = np.diff(np.append(starts, len(at)))
    pairs = starts[sizes == 2]
    a, b = prints[pairs], prints[pairs + 1]
    near = np.bitwise_count(a ^ b) <= radius
    lefts, rights = [a[near]], [b[near]]
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        left, right = forest(prints[start : start + size], radius)
        lefts.append(left)
        rights.append(right)
    left, right = np.concatenate(lefts).view(np.int64), np.concatenate(rights).view(np.int64)
    low, high = np.minimum(left, right), np.maximum(left, right)
    both = np.unique(np.stack([low, high]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among ``prints``: every print is compared
    with all that are not reached yet, starting from those just reached."""
    left, right = [], []
    rest = np.unique(prints)
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            one = reached.pop()
            near = np.bitwise_count(rest ^ one) <= radius
            found = rest[near]
            left += [one] * len(found)
            right += found.tolist()
            reached += found.tolist()
            rest = rest[~near]
        if not len(rest):
            break
    return np.array(left, np.uint64), np.array(right, np.uint64)


def near_duplicates(
    docs: DataFrame, held: Stored, shingle: int = 3, radius: int = 3,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Fingerprint and component of each document: ``key``, ``print`` (signed),
    ``component`` (lowest key reachable over links of ``radius`` bits or fewer).
    Keys may be of any type that has an order, a struct too.

    Null, empty and blank texts have fingerprint zero, linked like any other.
    Texts of fewer words than a shingle are one shingle.  Repeated rows and keys
    each give a row; a component all of whose keys are null is null.  An empty
    table gives no rows; other columns are ignored.
    """
    found = held.keep(fingerprints(docs, shingle, key, text))
    prints = held.keep(found.groupBy("print").agg(F.min("key").alias("low")))
    roots = components(near_links(prints.select("print"), radius), held)
    linked = prints.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "low", F.coalesce("root", "print").alias("root")
    )
    lowest = linked.groupBy("root").agg(F.min("low").alias("component"))
    of_print = linked.join(lowest, "root").select("print", "component")
    return found.join(of_print, "print").select("key", "print", "component")
