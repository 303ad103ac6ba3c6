"""Connected components of links between numbered nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.llm.storage import Stored


def components(links: DataFrame, held: Stored) -> DataFrame:
    """``node`` and ``root`` (the lowest node reachable) of every node with a link.

    ``links`` has the bigint columns ``a`` and ``b``.  Rounds of large-star and
    small-star: each node's higher, then its lower neighbours are linked to its
    lowest neighbour.  The number of links never grows and the rounds are
    logarithmic in the longest path.  Each round is stored, so a lost executor
    repeats one round at most.  Minima are combined before each shuffle.
    """
    now = held.keep(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while (state := _digest(now)) != before:
        before = state
        now = held.keep(_small_star(_large_star(now)))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _digest(links: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(hashed)).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    higher = both.filter("b > a").join(lowest, "a")
    return higher.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` have ``a`` above ``b``."""
    lowest = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(lowest, "a").filter("b <> m")
    kept = lowest.select("a", F.col("m").alias("b"))
    return kept.unionByName(moved.select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
