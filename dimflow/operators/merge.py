"""Write modes as new table versions: upsert, insert if absent, replace the
children of a parent, add up duplicate lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.checks import given
from dimflow.operators.dedup import first_per_key


def stamp(df: DataFrame, batch_ts: datetime, column: str = "scraped_at") -> DataFrame:
    return df.withColumn(column, F.lit(batch_ts).cast("timestamp"))


def with_full_key(df: DataFrame, key: list[str]) -> DataFrame:
    return df.filter(given(key))


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The last state wins per key.  Columns that ``new`` does not carry keep
    their old value.  ``new`` holds one row per key."""
    if set(old.columns) <= set(new.columns):
        untouched = old.join(new.select(*key), key, "left_anti")
        return untouched.unionByName(new.select(*old.columns))
    marked = new.withColumn("_given", F.lit(True)).alias("new")
    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in key]

    def state(name: str) -> Column:
        if name not in new.columns:
            return F.col(f"old.{name}")
        return F.when(F.col("new._given"), F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))

    joined = old.alias("old").join(marked, same_key, "full_outer")
    return joined.select(*[state(c).alias(c) for c in old.columns])


def span_of(df: DataFrame, column: str) -> tuple | None:
    """Column with its lowest and highest value, or None without rows.  Call it
    on a stored table, of which it reads this one column."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return None if low is None else (column, low, high)


def absent_rows(
    old: DataFrame,
    new: DataFrame,
    key: list[str],
    order: list[Column] | None = None,
    span: tuple | None = None,
) -> DataFrame:
    """Rows of ``new`` to append: full key, not in ``old``, the first per key.

    Copies of a key are dropped first, as that happens before the shuffle; the
    join that follows uses the same partitioning.
    ``span`` is the range of one key column in ``new``, such as its dates (see
    :func:`span_of`).  Only that part of ``old`` is read then, so a daily batch
    does not shuffle the whole history.
    """
    if span:
        column, low, high = span
        old = old.filter(F.col(column).between(F.lit(low), F.lit(high)))
    complete = with_full_key(new, key)
    single = first_per_key(complete, key, order) if order else complete
    return single.join(old.select(*key), key, "left_anti")


def insert_if_absent(
    old: DataFrame,
    new: DataFrame,
    key: list[str],
    order: list[Column] | None = None,
    span: tuple | None = None,
) -> DataFrame:
    """``old`` with the absent rows added; old rows never change."""
    return old.unionByName(absent_rows(old, new, key, order, span).select(*old.columns))


def replace_children(old: DataFrame, new: DataFrame, parent: str) -> DataFrame:
    """All rows of every parent in ``new`` are replaced; other parents keep
    theirs, and an empty batch changes nothing."""
    parents = new.select(parent).distinct()
    return old.join(parents, parent, "left_anti").unionByName(new.select(*old.columns))


def sum_duplicates(
    df: DataFrame, key: list[str], value: str, order: list[str] | None = None
) -> DataFrame:
    """One row per key with the sum of ``value``; every other column comes from
    the first row in ``order``."""
    others = [c for c in df.columns if c not in key and c != value]
    total = F.sum(value).alias(value)
    if not others:
        return df.groupBy(*key).agg(total)
    first = F.min_by(F.struct(*others), F.struct(*(order or others)))
    merged = df.groupBy(*key).agg(total, first.alias("_first"))
    return merged.select(*key, value, "_first.*")
