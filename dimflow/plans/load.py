"""Clean tables to the published relational tables: corrections, then the
write mode of each table's contract, parents before children."""

from __future__ import annotations

from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dimflow.contracts import (
    CHILDREN,
    CONTRACTS,
    FEE_COLUMNS,
    INSERT,
    POLICY_COLUMNS,
    RANK_COLUMNS,
    RATING_COLUMNS,
    RELATIONAL,
    conform,
    contract_checks,
    misfits,
)
from dimflow.functions import checks, text
from dimflow.operators.dedup import distinct_names, keep_first_code, last_per_key
from dimflow.operators.history import change_audit
from dimflow.operators.keys import number_absent, number_rows, resolve_keys
from dimflow.operators.merge import absent_rows, replace_children, span_of, stamp, upsert
from dimflow.operators.quality import (
    LOST,
    accepted,
    drop_zero_rows,
    first_reason,
    label_consistency,
    lost_rows,
    reject_rows,
    rejected,
    sum_anomalies,
    sum_checkpoint,
)
from dimflow.plans.transform import Clean
from dimflow.session import cut_lineage, run_together, shuffle_long
from dimflow.sources.published import Published

# Categories whose source name is wrong.
CATEGORY_NAMES = {9: "Real Estate"}
SOURCE_ORDER = ("file_name", "pos")
# Tables whose rows carry numbers that another table gives out.
NUMBERED_PARENTS = {"portfolio_allocation", "portfolio_holding"}


def corrected(name: str, df: DataFrame) -> DataFrame:
    """Fixes of known source faults; a value that cannot be told is nulled."""
    if name == "custodian_bank":
        return df.withColumn(
            "telephone", text.fit_width(F.col("telephone"), checks.TELEPHONE_WIDTH)
        )
    if name == "asset_category":
        return distinct_names(df, "category_id", "name", CATEGORY_NAMES)
    if name == "mutual_fund":
        fixes = {"min_next_subscription": checks.non_negative(F.col("min_next_subscription"))}
        for c in FEE_COLUMNS:
            fixes[c] = checks.below(F.col(c), checks.FEE_LIMIT_PCT)
        for c in POLICY_COLUMNS:
            fixes[c] = checks.within(F.col(c), 0, 100)
        # by fund too: in a landed table of many documents all may have one position
        return keep_first_code(df.withColumns(fixes), "isin_code", "pos", "fund_id")
    if name == "fund_performance":
        ratio = F.col("treynor_ratio")
        return df.withColumn("treynor_ratio", checks.magnitude_below(ratio, checks.RATIO_LIMIT))
    if name == "fund_ranking":
        return drop_zero_rows(df, [*RANK_COLUMNS, *RATING_COLUMNS])
    return df


def prepared(
    name: str, clean: Clean, published: Published
) -> tuple[DataFrame, DataFrame | None]:
    """Accepted clean rows with corrections and with the numbers of their
    parents, and the rows whose parent is not known."""
    df = clean.read(name)
    if "reject_reason" in df.columns:
        df = accepted(df)
    df = corrected(name, df)
    if name == "security":
        known = published.read_side("security")
        fresh = number_absent(known, df, ["code"], "security_id")
        return df.join(known.select("code", "security_id"), "code").unionByName(fresh), None
    if name == "portfolio_holding":
        df = df.join(published.read_side("security").select("code", "security_id"), "code")
    if name in ("portfolio_allocation", "portfolio_holding"):
        snapshots = published.read_side("portfolio_snapshot")
        key = ["fund_id", "date_based"]
        resolved = cut_lineage(resolve_keys(df, snapshots, key, "snapshot_id"))
        lost = resolved.filter("snapshot_id IS NULL").drop("snapshot_id")
        return resolved.filter("snapshot_id IS NOT NULL"), lost
    return df, None


def source_order(df: DataFrame) -> list[str]:
    return [c for c in SOURCE_ORDER if c in df.columns]


def merge_table(
    published: Published, name: str, new: DataFrame, batch: str, batch_ts: datetime, actor: str
) -> tuple[DataFrame | None, DataFrame]:
    """Write one table; returns its audit rows, if any, and the rejected rows."""
    contract = CONTRACTS[name]
    key = list(contract.key)
    rows = stamp(new, batch_ts) if contract.stamped else new
    lost = first_reason(misfits(rows, contract)).alias("_misfit")
    typed = conform(rows, contract, SOURCE_ORDER, lost)
    rules = {rule: ~holds for rule, holds in contract_checks(contract).items()}
    reason = F.coalesce("_misfit", first_reason(rules))
    marked = typed.withColumn("reject_reason", reason).drop("_misfit")
    # Stored, as accepted and rejected rows are both read from it, and as what the
    # optimizer infers from a filter over typed columns doubles with each of them.
    seen = Observation()
    marked = cut_lineage(marked.observe(seen, F.count(F.lit(1)).alias("rows")))
    marked = shuffle_long(marked, seen.get["rows"])
    bad = reject_rows(rejected(marked), name, key, batch)
    good, old = accepted(marked), published.read_side(name)
    order, columns = source_order(good), contract.schema.fieldNames()
    if contract.slice:
        slices = published.touched(name, good)
        before = published.read_slices(name, slices)
    if contract.mode == CHILDREN:
        rows = good.select(*columns).drop(contract.surrogate)
        numbered = number_rows(rows, rows.columns, contract.surrogate, after=old)
        replaced = replace_children(before, numbered, contract.key[0])
        published.replace_slices(name, slices, replaced, batch)
        return None, bad
    if contract.mode == INSERT:
        span = span_of(new, contract.span) if contract.span else None
        fresh = absent_rows(old, good, key, [F.col(c) for c in order], span).select(*columns)
        if contract.surrogate:
            fresh = number_rows(fresh.drop(contract.surrogate), key, contract.surrogate, after=old)
        published.append(name, fresh, batch)
        return None, bad
    state = (last_per_key(good, key, order) if order else good).select(*columns)
    if contract.slice:
        published.replace_slices(name, slices, upsert(before, state, key), batch)
        return None, bad
    published.replace(name, upsert(old, state, key), batch)
    if not contract.audited:
        return None, bad
    ignore = ("scraped_at",) if contract.stamped else ()
    return change_audit(old, state, key, name, batch_ts, actor, ignore), bad


def load(
    published: Published,
    clean: Clean,
    names: list[str],
    batch: str,
    batch_ts: datetime,
    actor: str = "dimflow",
) -> None:
    """Merge the named clean tables.  Lines that need the number of a portfolio
    or a security come after those; the others do not wait for each other."""
    audits, rejects = [], []

    def note(log: list, rows: DataFrame | None) -> None:
        if rows is not None:
            log.append(rows)

    def merge(name: str) -> None:
        new, lost = prepared(name, clean, published)
        if lost is not None:
            lost = lost.withColumn("reject_reason", F.lit("no portfolio"))
            note(rejects, reject_rows(lost, name, ["fund_id", "date_based"], batch))
        audit, bad = merge_table(published, name, new, batch, batch_ts, actor)
        note(rejects, bad)
        note(audits, audit)

    ordered = [c.name for c in RELATIONAL if c.name in names]
    run_together([partial(merge, n) for n in ordered if n not in NUMBERED_PARENTS])
    run_together([partial(merge, n) for n in ordered if n in NUMBERED_PARENTS])
    lost = [
        lost_rows(df, n, list(CONTRACTS[n].key), batch)
        for n in ordered
        if LOST in (df := clean.read(n)).columns
    ]
    if lost:
        key = list(CONTRACTS["cell_log"].key)
        found = reduce(DataFrame.unionByName, lost).dropDuplicates(key)
        published.append("cell_log", absent_rows(published.read_side("cell_log"), found, key), batch)
    if audits:
        published.append("audit_log", reduce(DataFrame.unionByName, audits), batch)
    if rejects:
        published.append("reject_log", reduce(DataFrame.unionByName, rejects), batch)


def portfolio_report(clean: Clean) -> tuple[DataFrame, DataFrame]:
    """Portfolios whose lines do not add up, and the overall counts."""
    key = ["fund_id", "date_based"]
    snapshots = clean.read("portfolio_snapshot").select(*key).distinct()
    allocations, holdings = clean.read("portfolio_allocation"), clean.read("portfolio_holding")
    return (
        sum_anomalies(snapshots, allocations, holdings, key, "value_pct"),
        sum_checkpoint(allocations, holdings, key, "value_pct"),
    )


def label_report(clean: Clean) -> DataFrame:
    """How far the derived fund labels agree with those the source gives."""
    return label_consistency(
        clean.read("mutual_fund"),
        F.col("conservative_label"),
        F.col("source_label"),
        F.col("fund_type").isNotNull(),
    )
