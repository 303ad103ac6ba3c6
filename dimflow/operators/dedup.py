"""Keep one row per key, by an explicit order.

None of these sends a whole key group to one task: Spark keeps only the best
row per key and task before the shuffle (``WindowGroupLimit`` for a rank of 1,
map-side combine for ``max_by``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimflow.session import cut_lineage


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.desc_nulls_last(c) for c in order])


def latest_per_key(df: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Row with the highest ``order`` per key.  ``order`` must be unique within
    a key, as a date is within a series."""
    return df.groupBy(*keys).agg(
        F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in columns]
    )


def keep_first_code(df: DataFrame, code: str, *position: str) -> DataFrame:
    """Null ``code`` on every row but the first that carries it, in the order of
    ``position``.  Rows alike in all of these columns keep it together.

    The first position per code comes from a map-side combined minimum and is
    joined back on code and position, so neither a code that fills the table nor
    the null code gathers in one task, and a row meets one first position at most,
    even where many rows share a position.
    """
    firsts = (
        df.filter(F.col(code).isNotNull())
        .groupBy(F.col(code).alias("_code"))
        .agg(F.min(F.struct(*position)).alias("_at"))
        .select("_code", *[F.col(f"_at.{p}").alias(f"_{p}") for p in position], F.lit(True).alias("_first"))
    )
    same = F.col(code) == F.col("_code")
    for p in position:
        same &= F.col(p).eqNullSafe(F.col(f"_{p}"))
    kept = F.when(F.col("_first"), F.col(code))
    # a merge, as there are as many codes as rows where codes are what they should be
    return df.join(firsts.hint("merge"), same, "left").withColumn(code, kept).select(*df.columns)


def distinct_names(df: DataFrame, key: str, name: str, overrides: dict | None = None) -> DataFrame:
    """Make names unique: an override by key replaces the name, and a name that
    a lower key already holds becomes ``"name (key)"``, again and again until no
    lower key holds it.  Each round is stored; there are as many as the longest
    chain of names that run into each other.
    """
    label = F.col(name)
    fixed = F.lit(False)
    for value, text in (overrides or {}).items():
        label = F.when(F.col(key) == value, F.lit(text)).otherwise(label)
        fixed = fixed | (F.col(key) == value)
    named = df.withColumn(name, label).withColumn("_fixed", fixed)
    while True:
        taken = cut_lineage(_mark_taken(named, key, name, named.select(key, name)))
        if taken.filter("_taken").isEmpty():
            return taken.select(*df.columns)
        suffixed = F.when(F.col("_taken"), _with_key(name, key)).otherwise(F.col(name))
        named = taken.withColumn(name, suffixed).drop("_taken")


def _with_key(name: str, key: str) -> Column:
    return F.concat(F.col(name), F.lit(" ("), F.col(key).cast("string"), F.lit(")"))


def _mark_taken(named: DataFrame, key: str, name: str, holders: DataFrame) -> DataFrame:
    """Flag the rows whose name has a holder with a lower key.  The join is on
    (key, name), which is unique, so a name shared by many rows is no hot key."""
    first = holders.groupBy(name).agg(F.min(key).alias(key))
    marked = named.join(first.withColumn("_holds", F.lit(True)), [key, name], "left")
    free = F.coalesce(F.col("_holds"), F.col("_fixed"))
    return marked.withColumn("_taken", ~F.coalesce(free, F.lit(False)) & ~F.col("_fixed")).drop(
        "_holds"
    )
