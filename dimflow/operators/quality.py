"""Validation: rejects with reasons, domain checks, duplicates, orphans, sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.checks import all_zero, given
from dimflow.functions.text import blank_to_null

# Tolerances of the source checks, in percent.
ALLOCATION_TOLERANCE_PCT = 5
LABEL_TOLERANCE_PCT = 5
FULL_PCT = 100


def first_reason(reasons: dict[str, Column]) -> Column:
    """Name of the first condition that holds, else null."""
    named = [F.when(bad, F.lit(name)) for name, bad in reasons.items()]
    return F.coalesce(*named, F.lit(None).cast("string"))


def mark_rejects(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    return df.withColumn("reject_reason", first_reason(reasons))


def accepted(marked: DataFrame) -> DataFrame:
    return marked.filter("reject_reason IS NULL").drop("reject_reason")


def rejected(marked: DataFrame) -> DataFrame:
    return marked.filter("reject_reason IS NOT NULL")


def reject_rows(bad: DataFrame, name: str, key: list[str], batch: str) -> DataFrame:
    return bad.select(
        F.lit(name).alias("table_name"),
        F.concat_ws(",", *[F.col(k).cast("string") for k in key]).alias("record_pk"),
        "reject_reason",
        F.lit(batch).alias("batch"),
    )


LOST = "lost_cells"


def lost_cells(cells: dict[str, tuple[Column, Column, str]]) -> Column:
    """The given values that a table cannot hold, as an array in the row itself:
    ``cells`` has the raw text, the parsed value and the reason by column.  Blank texts
    are not lost."""
    found = [
        F.when(
            blank_to_null(raw).isNotNull() & parsed.isNull(),
            F.struct(
                F.lit(name).alias("column_name"), raw.alias("raw_value"), F.lit(reason).alias("reason")
            ),
        )
        for name, (raw, parsed, reason) in cells.items()
    ]
    return F.array_compact(F.array(*found)).alias(LOST)


def lost_rows(df: DataFrame, name: str, key: list[str], batch: str) -> DataFrame:
    """One row per lost value of a stored table."""
    record = F.concat_ws(",", *[F.col(k).cast("string") for k in key])
    lost = df.filter(F.size(LOST) > 0).select(record.alias("record_pk"), F.inline(LOST))
    return lost.select(F.lit(name).alias("table_name"), "*", F.lit(batch).alias("batch"))


def reject_counts(marked: DataFrame) -> DataFrame:
    return rejected(marked).groupBy("reject_reason").agg(F.count("*").alias("n_rows"))


def drop_zero_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the rows in which all ``columns`` are zero at once."""
    return df.filter(~all_zero([F.col(c) for c in columns]))


def violations(df: DataFrame, key: list[str], checks: dict[str, Column]) -> DataFrame:
    """One row per key and failed check.  As with a table constraint, a check
    that is null counts as passed."""
    failed = F.array_compact(
        F.array(*[F.when(~holds, F.lit(name)) for name, holds in checks.items()])
    )
    return df.select(*key, F.explode(failed).alias("violation"))


def fits_decimal(c: Column, precision: int, scale: int) -> Column:
    return c.isNull() | c.try_cast(f"decimal({precision},{scale})").isNotNull()


def fits_width(c: Column, width: int) -> Column:
    return F.char_length(c) <= width


def duplicate_keys(df: DataFrame, key: list[str], where: Column | None = None) -> DataFrame:
    """Keys that occur more than once; a key with a null part is exempt."""
    rows = df if where is None else df.filter(where)
    counts = rows.filter(given(key)).groupBy(*key).agg(F.count("*").alias("n_rows"))
    return counts.filter("n_rows > 1")


def orphans(
    children: DataFrame, foreign_key: list[str], parents: DataFrame, parent_key: list[str]
) -> DataFrame:
    """Foreign keys without a parent and their row counts.  Children are counted
    per key first, so the join sees each key once however hot it is."""
    counts = (
        children.filter(given(foreign_key))
        .groupBy(*foreign_key)
        .agg(F.count("*").alias("n_rows"))
    )
    renamed = parents.select(*[F.col(p).alias(f) for f, p in zip(foreign_key, parent_key)])
    return counts.join(renamed, foreign_key, "left_anti")


def children_of(children: DataFrame, key: list[str], parents: DataFrame) -> DataFrame:
    """Children whose parent is still there (cascade after a delete)."""
    return children.join(parents.select(*key), key, "left_semi")


def label_consistency(df: DataFrame, derived: Column, given: Column, counted: Column) -> DataFrame:
    """How many derived labels differ from the given ones, and the verdict."""
    differs = counted & ~derived.eqNullSafe(given)
    share = F.col("mismatches") / F.nullif(F.col("checked"), F.lit(0).cast("bigint")) * 100
    return (
        df.agg(F.count_if(counted).alias("checked"), F.count_if(differs).alias("mismatches"))
        .withColumn("mismatch_pct", F.coalesce(share, F.lit(0.0)))
        .withColumn("rule_holds", F.col("mismatch_pct") <= LABEL_TOLERANCE_PCT)
    )


def _tagged_lines(
    allocations: DataFrame, holdings: DataFrame, key: list[str], value: str
) -> DataFrame:
    """Both kinds of lines in one table, so that they are shuffled once."""
    parts = [
        lines.select(*key, F.col(value).alias("_value"), F.lit(tag).alias("_allocates"))
        for lines, tag in ((allocations, True), (holdings, False))
    ]
    return parts[0].unionByName(parts[1])


def sum_anomalies(
    snapshots: DataFrame,
    allocations: DataFrame,
    holdings: DataFrame,
    key: list[str],
    value: str,
) -> DataFrame:
    """Snapshots whose allocation sum is off 100 by more than the tolerance, or
    whose holdings exceed 100.  A snapshot without lines has a sum of zero."""
    lines = _tagged_lines(allocations, holdings, key, value)
    per_kind = {"allocation_sum": F.col("_allocates"), "holding_sum": ~F.col("_allocates")}
    sums = lines.groupBy(*key).agg(
        *[F.sum(F.when(kind, F.col("_value"))).alias(name) for name, kind in per_kind.items()]
    )
    zero = F.lit(0).cast("int")
    filled = snapshots.select(*key).join(sums, key, "left").withColumns(
        {name: F.coalesce(name, zero) for name in per_kind}
    )
    off = F.abs(F.col("allocation_sum") - FULL_PCT) > ALLOCATION_TOLERANCE_PCT
    over = F.col("holding_sum") > FULL_PCT
    marked = filled.withColumn("allocation_off", off).withColumn("holding_over", over)
    return marked.filter(off | over)


def sum_checkpoint(
    allocations: DataFrame, holdings: DataFrame, key: list[str], value: str
) -> DataFrame:
    """One row of counts over the snapshots that have lines at all."""
    lines = _tagged_lines(allocations, holdings, key, value)
    sums = lines.groupBy(*key, "_allocates").agg(F.sum("_value").alias("_sum"))
    allocates, total = F.col("_allocates"), F.col("_sum")
    off = F.abs(total - FULL_PCT) > ALLOCATION_TOLERANCE_PCT
    held = F.when(~allocates, total)
    return sums.agg(
        F.count_if(allocates).alias("allocation_snapshots"),
        F.count_if(allocates & off).alias("allocation_off"),
        F.count_if(allocates & ~off).alias("allocation_near_full"),
        F.count_if(~allocates).alias("holding_snapshots"),
        F.min(held).alias("holding_min"),
        F.max(held).alias("holding_max"),
    )


def fingerprint(df: DataFrame, columns: list[Column]) -> DataFrame:
    """Row count and an order-free sum of row digests: equal for equal results.

    Each field stands with its length, so fields cannot run together, and both
    halves of the 128-bit digest are summed.
    """
    fields = [c.cast("string") for c in columns]
    sized = [F.coalesce(F.concat_ws(":", F.length(f), f), F.lit("-")) for f in fields]
    text = F.concat_ws("|", *[F.when(f.isNull(), F.lit("-")).otherwise(s) for f, s in zip(fields, sized)])
    digest = F.md5(text)
    halves = [
        F.sum(F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(38,0)")).cast("string")
        for at in (1, 17)
    ]
    return df.agg(F.count("*").alias("n_rows"), F.concat_ws("-", *halves).alias("digest"))
