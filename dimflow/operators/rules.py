"""All rules of a set of tables in one scan of each.

A row gives an entry for every check that it fails, for each of its unique keys, for
each foreign key, and for each of its keys that others refer to.  Entries are counted
by rule and value in one shuffle: a unique value that counts twice is repeated, and a
foreign key that no parent entry meets has no parent.  Entries are combined before
the shuffle, so a value of many rows is no hot key.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.functions.checks import given

CHECK, UNIQUE, CHILD = "check", "unique", "foreign key"


@dataclass(frozen=True)
class Rules:
    """``checks`` by name; ``unique`` columns by name, with a condition or None;
    ``parents``: table and key by foreign key."""

    checks: dict[str, Column] = field(default_factory=dict)
    unique: dict[str, tuple[list[str], Column | None]] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)


def broken_rules(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """``table_name``, ``rule`` and ``n_rows`` of every rule that some rows break.

    As with table constraints, a check that is null holds, and a key with a null part
    is neither repeated nor without a parent.
    """
    entries = [_entries(name, tables[name], rules) for name in tables]
    counted = (
        reduce(DataFrame.unionByName, [e for e in entries if e is not None])
        .groupBy("table_name", "rule", "kind", "value")
        .agg(F.count_if(~F.col("is_parent")).alias("n"), F.count_if("is_parent").alias("parents"))
    )
    broken = (
        ((F.col("kind") == CHECK) & (F.col("n") > 0))
        | ((F.col("kind") == UNIQUE) & (F.col("n") > 1))
        | ((F.col("kind") == CHILD) & (F.col("parents") == 0))
    )
    return counted.filter(broken).groupBy("table_name", "rule").agg(F.sum("n").alias("n_rows"))


def _entries(name: str, table: DataFrame, rules: dict[str, Rules]) -> DataFrame | None:
    mine = rules.get(name, Rules())

    def entry(of: str, rule: str, kind: str, value: Column, is_parent: bool = False) -> Column:
        return F.struct(
            F.lit(of).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.lit(kind).alias("kind"),
            value.alias("value"),
            F.lit(is_parent).alias("is_parent"),
        )

    nothing = F.lit(None).cast("string")
    found = [F.when(~holds, entry(name, rule, CHECK, nothing)) for rule, holds in mine.checks.items()]
    for rule, (columns, where) in mine.unique.items():
        counts = given(columns) if where is None else given(columns) & where
        key = F.to_json(F.struct(*[F.col(c).cast("string") for c in columns]))
        found.append(F.when(counts, entry(name, rule, UNIQUE, key)))
    for column, (parent, _) in mine.parents.items():
        value = F.col(column).cast("string")
        rule = f"{column} in {parent}"
        found.append(F.when(F.col(column).isNotNull(), entry(name, rule, CHILD, value)))
    for child, others in rules.items():
        for column, (parent, key) in others.parents.items():
            if parent == name:
                value = F.col(key).cast("string")
                there = entry(child, f"{column} in {parent}", CHILD, value, is_parent=True)
                found.append(F.when(F.col(key).isNotNull(), there))
    if not found:
        return None
    return table.select(F.explode(F.array_compact(F.array(*found))).alias("e")).select("e.*")
