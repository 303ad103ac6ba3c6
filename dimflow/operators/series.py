"""Time series per owner: previous value, period return, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimflow.functions.checks import given, ratio
from dimflow.operators.merge import span_of


def with_previous(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, slot: str = "year"
) -> DataFrame:
    """Add the value of the preceding row per key, in the order of a date.

    A series is cut into calendar slots and each (key, slot) is one window
    group, so one owner that holds a large part of all rows spreads over many
    tasks.  The first row of a slot takes the last value of the owner's
    previous slot, which comes from a small combined aggregate of one row per
    owner and slot; the join back on (key, slot) reuses the window's shuffle.
    Rows without an owner or a date belong to no series and are left out.
    """
    rows = df.filter(given([*keys, order])).withColumn("_slot", F.trunc(order, slot))
    lasts = rows.groupBy(*keys, "_slot").agg(F.max_by(value, order).alias("_last"))
    return _before_each(rows, lasts, keys, order, value, out).select(*df.columns, out)


def _before_each(
    rows: DataFrame, lasts: DataFrame, keys: list[str], order: str, value: str, out: str
) -> DataFrame:
    """Previous value of slotted rows, given the last value of each slot."""
    group = [*keys, "_slot"]
    by_owner = Window.partitionBy(*keys).orderBy("_slot")
    carried = lasts.select(*group, F.lag("_last").over(by_owner).alias("_carried"))
    in_slot = Window.partitionBy(*group).orderBy(order)
    placed = rows.withColumn("_n", F.row_number().over(in_slot)).withColumn(
        "_before", F.lag(value).over(in_slot)
    )
    previous = F.when(F.col("_n") == 1, F.col("_carried")).otherwise(F.col("_before"))
    # a merge, as the rows lie by group already, and as slots grow with the series
    return placed.join(carried.hint("merge"), group, "left").withColumn(out, previous)


def previous_of(
    new: DataFrame,
    history: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    out: str,
    slot: str = "year",
) -> DataFrame:
    """:func:`with_previous` of ``history``, for its rows in ``new`` alone.

    ``new`` is a stored table of keys and dates, such as the rows of one batch.
    Only its slots and the slot before are read; the rest of the history is
    read, without a shuffle of it, just for owners that have no row in those.
    """
    span = span_of(new, order)
    if span is None:
        return history.limit(0).withColumn(out, F.col(value))
    _, low, high = span
    start = F.trunc(F.lit(low), slot)
    near_start = F.trunc(F.date_sub(start, 1), slot)
    day = F.col(order)
    slotted = history.filter(given([*keys, order])).withColumn("_slot", F.trunc(order, slot))
    near = slotted.filter((day >= near_start) & (day <= F.lit(high)))

    touched = new.select(*keys, F.trunc(order, slot).alias("_slot")).distinct()
    owners = touched.groupBy(*keys).agg(F.min("_slot").alias("_first_slot"))
    ends = near.groupBy(*keys, "_slot").agg(F.max_by(value, order).alias("_last"))
    lasts = ends.join(owners.select(*keys), keys, "left_semi")
    led = lasts.join(owners, keys).filter("_slot < _first_slot").select(*keys).distinct()
    unled = owners.join(led, keys, "left_anti").select(*keys)
    if not unled.isEmpty():
        far = slotted.filter(day < near_start).join(unled, keys, "left_semi")
        far_ends = far.groupBy(*keys).agg(
            F.max("_slot").alias("_slot"), F.max_by(value, order).alias("_last")
        )
        lasts = lasts.unionByName(far_ends)
    rows = near.filter(day >= start).join(touched, [*keys, "_slot"], "left_semi")
    found = _before_each(rows, lasts, keys, order, value, out)
    return found.select(*history.columns, out).join(
        new.select(*keys, order), [*keys, order], "left_semi"
    )


def with_return(df: DataFrame, value: str, previous: str, out: str) -> DataFrame:
    change = ratio(F.col(value) - F.col(previous), F.col(previous))
    return df.withColumn(out, change)


def period_return(
    df: DataFrame,
    keys: list[str],
    order: str,
    value: str,
    previous: str,
    out: str = "daily_return",
    slot: str = "year",
) -> DataFrame:
    """Relative change against the preceding row; null on the first row."""
    return with_return(with_previous(df, keys, order, value, previous, slot), value, previous, out)


def latest_return(
    df: DataFrame, keys: list[str], order: str, value: str, out: str = "daily_return"
) -> DataFrame:
    """Newest row per key with its change against the row before.

    Equal to :func:`period_return` followed by the newest row per key, but only
    two rows per key and task leave the scan: the rank limit is applied before
    the shuffle.
    """
    newest_first = Window.partitionBy(*keys).orderBy(F.desc(order))
    two = (
        df.filter(given([*keys, order]))
        .withColumn("_rank", F.row_number().over(newest_first))
        .filter("_rank <= 2")
    )
    before = two.withColumn("_before", F.lead(value).over(newest_first)).filter("_rank = 1")
    change = ratio(F.col(value) - F.col("_before"), F.col("_before"))
    return before.select(*keys, order, value, change.alias(out))


def nav_return(nav: DataFrame, new: DataFrame | None = None) -> DataFrame:
    """Prices with their daily return; of the rows in ``new`` alone when given."""
    series = nav.select("fund_id", "record_date", "nav_value")
    names = (["fund_id"], "record_date", "nav_value", "prev_nav_value")
    if new is None:
        return period_return(series, *names)
    known = previous_of(new, series, *names)
    return with_return(known, "nav_value", "prev_nav_value", "daily_return")


def benchmark_return(points: DataFrame, **options) -> DataFrame:
    """Points of each benchmark with their return; options as :func:`period_return`."""
    series = points.select("benchmark_id", "record_date", "value")
    returns = period_return(series, ["benchmark_id"], "record_date", "value", "_prev", **options)
    return returns.drop("_prev")


def batch_coverage(df: DataFrame, day: str, stamped: str, newest: int = 10) -> DataFrame:
    """Rows per day with the first and last batch that wrote them."""
    return (
        df.groupBy(day)
        .agg(
            F.count("*").alias("n_rows"),
            F.min(stamped).alias("first_batch"),
            F.max(stamped).alias("last_batch"),
        )
        .orderBy(F.desc(day))
        .limit(newest)
    )
