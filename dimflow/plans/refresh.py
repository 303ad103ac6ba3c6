"""One run of the chain, which a scheduler may call."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.contracts import CHILDREN, RELATIONAL, STAR, VERSIONS, contract_checks
from dimflow.operators.rules import Rules, broken_rules
from dimflow.plans.load import load
from dimflow.plans.mart import load_mart
from dimflow.plans.transform import Clean, tables_of, transform
from dimflow.sources.published import Published, table_counts


def refresh(
    spark: SparkSession,
    raw: str,
    work: str,
    root: str,
    batch_ts: datetime,
    scope: str = "full",
    subset: int | None = None,
    full: bool = False,
    *,
    rating_field: str,
    landed: str | None = None,
) -> Published:
    """Documents to clean tables, to published tables, to the star schema.

    Readers see the new state only when the whole run is done.  Running it
    again on the same documents changes nothing but the batch time of upserted
    rows.  A run that failed goes on from its last finished stage when it is called
    with the same ``batch_ts`` and folders.  ``full`` checks all rows for missing
    facts, not only the new ones.  ``landed`` names the folder of landed tables, see
    :func:`transform`.
    """
    batch = batch_ts.strftime("%Y%m%dT%H%M%S")
    clean = Clean(spark, f"{work.rstrip('/')}/{batch}")
    published = Published(spark, root)
    names = tables_of(scope)
    stages = {
        "transform": lambda: transform(
            spark, raw, clean, scope, subset, rating_field=rating_field, landed=landed
        ),
        "load": lambda: load(published, clean, names, batch, batch_ts),
        "mart": lambda: load_mart(published, batch, batch_ts.date(), full),
    }
    run_stages(published, batch, stages)
    published.publish(batch)
    return published


def run_stages(published: Published, batch: str, stages: dict[str, Callable[[], object]]) -> list[str]:
    """Run the stages of a batch that are not done yet, in order, and note each;
    returns the names of those that were run."""
    done = published.resume(batch)
    left = [name for name in stages if name not in done]
    for name in left:
        stages[name]()
        published.note(batch, name)
    return left


def counts(published: Published) -> DataFrame:
    return table_counts({name: published.read(name) for name in published.folders})


def contract_rules() -> dict[str, Rules]:
    """The rules of all contracts: checks, unique columns, row keys and foreign keys of
    the relational tables, and one current version per key of a history."""
    rules = {}
    for contract in RELATIONAL:
        unique = {f"unique {u}": (list(u), None) for u in contract.unique}
        if contract.mode != CHILDREN:
            unique["unique key"] = (list(contract.key), None)
        rules[contract.name] = Rules(contract_checks(contract), unique, contract.parents)
    for contract in STAR:
        if contract.slice == VERSIONS:
            one = {"one current version": (list(contract.key), F.col("is_current"))}
            rules[contract.name] = Rules(unique=one)
    return rules


def integrity_report(published: Published) -> DataFrame:
    """Rows against the contracts: failed checks, repeated unique values and keys, and
    foreign keys without a parent.  Each table is scanned once."""
    rules = contract_rules()
    return broken_rules({name: published.read(name) for name in rules}, rules)
