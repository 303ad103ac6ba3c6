"""Surrogate keys: dense numbers in key order, stable over re-runs."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.session import cut_lineage, lookup

ROW_BITS = 33  # monotonically_increasing_id keeps the row position in these low bits


def number_rows(
    df: DataFrame, order: list[str], out: str, after: DataFrame | None = None
) -> DataFrame:
    """Number rows 1, 2, … in the order of ``order``, or on from the highest
    number in column ``out`` of ``after``.

    Where there are other columns, the distinct keys alone are sorted and numbered,
    rows with one key share its number, and the columns are joined back; ``df`` is
    read twice then and should be cheap to read.  Where there are none, equal rows
    get numbers of their own.
    """
    others = [c for c in df.columns if c not in order]
    if not others:
        return _numbered(df, order, out, after)[0]
    keys, n = _numbered(df.select(*order).distinct(), order, out, after)
    named = lookup(keys.select(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(order)], out), n)
    same = [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(order)]
    return df.join(named, reduce(and_, same)).select(*df.columns, out)


def _numbered(
    df: DataFrame, order: list[str], out: str, after: DataFrame | None
) -> tuple[DataFrame, int]:
    """The numbered rows and how many they are.

    One range-partitioned sort; no window over all rows.  The sorted rows are
    stored first, so that a lost executor cannot move a row to another
    partition between counting and numbering.  Only one count per partition of
    the sort reaches the driver.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", ROW_BITS)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    if after is not None:
        known = after.agg(F.lit(-1).cast("bigint").alias("part"), F.max(out).alias("n"))
        counts = counts.unionByName(known)
    offsets, total, n = [], 1, 0
    for row in sorted(counts.filter("n IS NOT NULL").collect()):
        offsets.append((row["part"], total))
        total += row["n"]
        n += row["n"] if row["part"] >= 0 else 0
    base = df.sparkSession.createDataFrame(offsets, "_part bigint, _base bigint")
    row_in_part = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(base), "_part")  # one row per partition of the sort
        .withColumn(out, F.col("_base") + row_in_part)
        .drop("_at", "_part", "_base")
    )
    return numbered, n


def number_absent(known: DataFrame, incoming: DataFrame, key: list[str], out: str) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``known``, numbered on from the
    highest number that ``known`` holds.  Known keys keep their number."""
    absent = incoming.join(known.select(*key), key, "left_anti")
    return number_rows(absent, key, out, after=known)


def resolve_keys(children: DataFrame, key_map: DataFrame, key: list[str], out: str) -> DataFrame:
    """Children with the number of their parent, null where there is none.  One
    join; a caller that wants both kinds of rows stores it before it filters."""
    return children.join(key_map.select(*key, out), key, "left")
