"""Change audit and dimension history."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.checks import differs, row_image
from dimflow.operators.keys import number_absent, number_rows
from dimflow.session import cut_lineage


def change_audit(
    before: DataFrame,
    after: DataFrame,
    key: list[str],
    table: str,
    changed_at: datetime,
    actor: str,
    ignore: tuple[str, ...] = (),
) -> DataFrame:
    """One row per key that both states hold and whose other columns differ.

    Columns in ``ignore`` do not make a change but are part of the images.
    Added and removed keys give no row.
    """
    columns = before.columns
    compared = [c for c in columns if c not in key and c not in ignore]
    old, new = before.alias("old"), after.select(*columns).alias("new")
    same_key = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in key]
    changed = differs(_of("old", compared), _of("new", compared))
    record = F.concat_ws(",", *[F.col(f"new.{k}").cast("string") for k in key])
    return (
        old.join(new, same_key)
        .filter(changed)
        .select(
            F.lit(table).alias("table_name"),
            record.alias("record_pk"),
            F.lit(changed_at).cast("timestamp").alias("changed_at"),
            row_image(_of("old", columns)).alias("old_values"),
            row_image(_of("new", columns)).alias("new_values"),
            F.lit(actor).alias("changed_by"),
        )
    )


def _of(alias: str, columns: list[str]) -> list[Column]:
    return [F.col(f"{alias}.{c}") for c in columns]


KEPT, CLOSED, OPENED = "kept", "closed", "opened"


def scd2_states(
    current: DataFrame,
    source: DataFrame,
    key: list[str],
    tracked: list[str],
    carried: list[str],
    effective: date,
) -> DataFrame:
    """What becomes of the current versions and the source rows of one batch.

    One full outer join; each of its rows gives one version or two, marked in
    column ``_state``: ``kept``, ``closed`` at ``effective`` as tracked columns
    have changed, or ``opened`` for a source key without a remaining current
    version.  Opened versions have no surrogate number yet.
    """
    cur = current.select(*[F.col(k).alias(f"_{k}") for k in key], F.struct("*").alias("cur"))
    src = source.select(
        *[F.col(k).alias(f"_of_{k}") for k in key], F.struct(*key, *tracked, *carried).alias("src")
    )
    joined = cur.join(src, [F.col(f"_{k}") == F.col(f"_of_{k}") for k in key], "full_outer")
    today = F.lit(effective).cast("date")
    known, given = F.col("cur").isNotNull(), F.col("src").isNotNull()
    changed = known & given & differs(_of("cur", tracked), _of("src", tracked))

    def version(state: Column, values: dict[str, Column], row: str) -> Column:
        present = {*key, *tracked, *carried} if row == "src" else set(current.columns)
        columns = [
            values.get(f.name, F.col(f"{row}.{f.name}") if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in current.schema
        ]
        return F.struct(*columns, state.alias("_state"))

    ends = {
        "valid_to": F.when(changed, today).otherwise(F.col("cur.valid_to")),
        "is_current": ~changed,
    }
    old = version(F.when(changed, F.lit(CLOSED)).otherwise(F.lit(KEPT)), ends, "cur")
    begins = {"valid_from": today, "valid_to": F.lit(None), "is_current": F.lit(True)}
    new = version(F.lit(OPENED), begins, "src")
    both = F.array(F.when(known, old), F.when(~known | changed, new))
    return joined.select(F.inline(F.array_compact(both)))


def scd2_merge(
    dim: DataFrame,
    source: DataFrame,
    key: list[str],
    tracked: list[str],
    carried: list[str],
    effective: date,
    surrogate: str,
) -> DataFrame:
    """Versioned dimension after one batch.

    A current version whose tracked columns changed is closed at
    ``effective``.  Each source key without a remaining current version gets a
    new one.  Keys that the source no longer holds stay as they are, and a
    change in ``carried`` columns alone makes no version.
    """
    current = dim.filter("is_current")
    states = cut_lineage(scd2_states(current, source, key, tracked, carried, effective))
    known = states.filter(F.col("_state") != OPENED).select(*dim.columns)
    opened = states.filter(F.col("_state") == OPENED).drop("_state", surrogate)
    numbered = number_rows(opened, key, surrogate, after=dim)
    return (
        dim.filter(~F.col("is_current")).unionByName(known).unionByName(numbered.select(*dim.columns))
    )


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def scd1_insert(dim: DataFrame, source: DataFrame, key: list[str], surrogate: str) -> DataFrame:
    """Add the distinct source keys that the dimension does not hold yet."""
    fresh = number_absent(dim, source.select(*key).distinct(), key, surrogate)
    return dim.unionByName(fresh.select(*dim.columns))
