"""Deletes in the published relational tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.contracts import CONTRACTS, RELATIONAL
from dimflow.operators.cascade import DOOMED, Link, forbidden, survivors, sweep
from dimflow.session import run_together
from dimflow.sources.published import Published, slice_of

LINKS = [
    Link(c.name, column, parent, key, column not in c.restricted)
    for c in RELATIONAL
    for column, (parent, key) in c.parents.items()
]


class RestrictedDelete(ValueError):
    """A row that stays names one that was to go."""


def delete_rows(published: Published, name: str, keys: DataFrame, batch: str) -> dict[str, int]:
    """Delete the rows of table ``name`` that ``keys`` names, and all that hangs on
    them by the contracts; returns the number of rows deleted per table.

    Nothing is written if a foreign key that does not cascade still needs a row.
    Tables without a doomed row stay as they are; of a sliced table only the slices
    with doomed rows are written anew.  The caller publishes.
    """
    tables = {c.name: published.read(c.name) for c in RELATIONAL}
    marked = sweep(tables, LINKS, name, keys)
    refused = forbidden(tables, marked, LINKS)
    found = refused.collect() if refused is not None else []
    if found:
        held = ", ".join(f"{r['n_rows']} rows of {r['table_name']} by {r['column']}" for r in found)
        raise RestrictedDelete(f"{name}: still needed by {held}")
    deleted = {}

    def write(table: str) -> None:
        gone = marked[table].filter(DOOMED)
        n = gone.count()
        if not n:
            return
        deleted[table] = n
        if CONTRACTS[table].slice:
            slices = published.touched(table, gone)
            rest = survivors(marked[table]).filter(slice_of(CONTRACTS[table]).isin(slices))
            published.replace_slices(table, slices, rest, batch)
        else:
            published.replace(table, survivors(marked[table]), batch)

    run_together([partial(write, table) for table in marked])
    return deleted


def deleted_counts(marked: dict[str, DataFrame]) -> DataFrame:
    """Rows deleted and left per table, in one plan."""
    parts = [
        rows.agg(F.count_if(DOOMED).alias("n_deleted"), F.count_if(~F.col(DOOMED)).alias("n_left")).select(
            F.lit(name).alias("table_name"), "n_deleted", "n_left"
        )
        for name, rows in marked.items()
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total
