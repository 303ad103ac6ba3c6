"""Deletes that sweep through a graph of foreign keys, parents before children."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from graphlib import TopologicalSorter
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.session import cut_lineage

DOOMED = "_doomed"


@dataclass(frozen=True)
class Link:
    """Column ``column`` of ``child`` names a row of ``parent`` by ``key``.  A link
    that does not cascade forbids to delete a parent that still has children."""

    child: str
    column: str
    parent: str
    key: str
    cascades: bool = True


def sweep(
    tables: dict[str, DataFrame], links: list[Link], start: str, keys: DataFrame
) -> dict[str, DataFrame]:
    """The tables that a delete reaches, with a flag ``_doomed`` on each row.

    The delete starts at the rows of ``start`` that ``keys`` names.  Tables are taken
    parents first; a row is doomed if a parent of it is, over any cascading link.
    Every table is joined to the distinct doomed keys of its parents only and stored,
    so each level reads the level before and no table is read twice.  A null foreign
    key has no parent.  A cycle of links is an error.
    """
    marked = {start: _mark(tables[start], [(list(keys.columns), keys)])}
    for name in _reached(links, start):
        gone = [
            ([link.column], doomed_keys(marked, link).withColumnRenamed(link.key, link.column))
            for link in links
            if link.child == name and link.cascades and link.parent in marked
        ]
        marked[name] = _mark(tables[name], gone)
    return marked


def doomed_keys(marked: dict[str, DataFrame], link: Link) -> DataFrame:
    return marked[link.parent].filter(DOOMED).select(link.key)


def _mark(table: DataFrame, gone: list[tuple[list[str], DataFrame]]) -> DataFrame:
    for i, (columns, keys) in enumerate(gone):
        flagged = keys.dropna().distinct().withColumn(f"_hit{i}", F.lit(True))
        table = table.join(flagged, columns, "left")
    hits = [F.coalesce(F.col(f"_hit{i}"), F.lit(False)) for i in range(len(gone))]
    marked = table.withColumn(DOOMED, reduce(or_, hits))
    return cut_lineage(marked.drop(*[f"_hit{i}" for i in range(len(gone))]))


def _reached(links: list[Link], start: str) -> list[str]:
    """Tables below ``start`` over cascading links, parents first."""
    parents: dict[str, set[str]] = {}
    for link in links:
        if link.cascades:
            parents.setdefault(link.child, set()).add(link.parent)
    order = list(TopologicalSorter(parents).static_order())
    below = {start}
    for name in order:
        if parents.get(name, set()) & below:
            below.add(name)
    return [name for name in order if name in below and name != start]


def forbidden(
    tables: dict[str, DataFrame], marked: dict[str, DataFrame], links: list[Link]
) -> DataFrame | None:
    """Rows that stay but name a doomed parent over a link that does not cascade, by
    child table and column; None if no such link is touched."""
    parts = []
    for link in links:
        if link.cascades or link.parent not in marked:
            continue
        rows = marked.get(link.child, tables[link.child])
        if link.child in marked:
            rows = rows.filter(~F.col(DOOMED))
        gone = doomed_keys(marked, link).distinct().withColumnRenamed(link.key, link.column)
        held = rows.groupBy(link.column).agg(F.count("*").alias("n")).join(gone, link.column, "left_semi")
        parts.append(
            held.agg(F.sum("n").alias("n_rows")).select(
                F.lit(link.child).alias("table_name"), F.lit(link.column).alias("column"), "n_rows"
            )
        )
    if not parts:
        return None
    return reduce(DataFrame.unionByName, parts).filter("n_rows > 0")


def survivors(marked: DataFrame) -> DataFrame:
    return marked.filter(~F.col(DOOMED)).drop(DOOMED)
