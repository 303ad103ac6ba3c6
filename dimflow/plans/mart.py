"""Star schema from the published relational tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.contracts import CONTRACTS, MOMENTS, REJECT_LOG, WAITING, conform, misfits
from dimflow.functions import dates, labels
from dimflow.operators.history import CLOSED, KEPT, OPENED, current_versions, scd1_insert, scd2_states
from dimflow.operators.keys import number_rows
from dimflow.operators.merge import absent_rows, span_of
from dimflow.operators.quality import accepted, first_reason, reject_rows, rejected
from dimflow.operators.series import latest_return, nav_return
from dimflow.plans.reports import monthly_moments
from dimflow.session import cut_lineage, lookup, run_together
from dimflow.sources.published import Published

FUND_TRACKED = [
    "name",
    "class_name",
    "isin_code",
    "currency_code",
    "is_sharia",
    "is_etf",
    "is_index",
    "official_benchmark",
]


def calendar(series: list[DataFrame], day: str) -> DataFrame:
    """All days from the first to the last date of the given series."""
    spans = [s.agg(F.min(day).alias("low"), F.max(day).alias("high")) for s in series]
    span = spans[0]
    for other in spans[1:]:
        span = span.unionByName(other)
    bounds = span.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    days = bounds.filter("low IS NOT NULL").select(F.explode(F.sequence("low", "high")).alias("d"))
    return days.select(*dates.calendar_columns(F.col("d")))


def star_keys(
    owners: DataFrame,
    dim_fund: DataFrame,
    dim_manager: DataFrame,
    dim_custodian: DataFrame,
    dim_category: DataFrame,
) -> DataFrame:
    """One row per fund with the keys of its current dimension versions.

    Facts join this once instead of five dimensions in turn; it has a row per fund,
    so :func:`load_mart` has it broadcast as long as these fit the session's
    threshold and shuffled beyond that.
    """
    return (
        owners.join(current_versions(dim_fund).select("fund_id", "dim_fund_key"), "fund_id")
        .join(current_versions(dim_manager).select("manager_id", "dim_manager_key"), "manager_id")
        .join(current_versions(dim_custodian).select("bank_id", "dim_custodian_key"), "bank_id")
        .join(dim_category, ["label", "fund_type_code"])
        .select("fund_id", "dim_fund_key", "dim_manager_key", "category_id", "dim_custodian_key")
    )


def fact_rows(measures: DataFrame, keys: DataFrame, owner: str, day: str) -> DataFrame:
    """Measures with their date key and dimension keys."""
    return measures.join(keys, owner).withColumn("date_id", dates.date_key(F.col(day)))


def version_dimension(
    published: Published,
    name: str,
    source: DataFrame,
    tracked: list[str],
    carried: list[str],
    effective: date,
    batch: str,
) -> None:
    """Bring a stored history up to date.

    Only the current versions are joined to the source, once, and written anew.
    Versions that end are added in a folder of their own; those that ended before
    are not read but for their numbers, and a batch without changes writes nothing.
    """
    contract = CONTRACTS[name]
    key, surrogate = list(contract.key), contract.surrogate
    current = published.read_slices(name, ["current"])
    states = cut_lineage(scd2_states(current, source, key, tracked, carried, effective))
    sizes = dict(states.groupBy("_state").count().collect())
    if not sizes.get(CLOSED) and not sizes.get(OPENED):
        published.folders.setdefault(name, [])
        published.counts.setdefault(name, 0)
        return

    def of(state: str) -> DataFrame:
        return states.filter(F.col("_state") == state).drop("_state")

    numbered = number_rows(of(OPENED).drop(surrogate), key, surrogate, after=published.read(name))
    if sizes.get(CLOSED):
        published.append(name, of(CLOSED), f"{batch}-closed")
    now = of(KEPT).unionByName(numbered.select(*current.columns))
    published.replace_slices(name, ["current"], now, batch)


def load_mart(published: Published, batch: str, effective: date, full: bool = False) -> None:
    """Dimensions first, then facts on their natural grain, then the stored
    latest value per fund.

    Facts are made of the rows that this run has appended to the relational
    tables, and of those that earlier runs could not place because a dimension
    missed their key (``fact_waiting``).  A fact table that is not there yet, or
    ``full``, looks at all rows.  A fact with a value that does not fit its column
    goes to the reject log.  Days and latest prices come from the appended rows
    and from what is stored, not from the whole history.
    """
    funds = published.read("mutual_fund")
    nav = published.read("nav_record")

    run_together(
        [
            lambda: _append(published, "dim_date", _days(published, full), batch),
            lambda: published.replace("dim_category", _categories(published, funds), batch),
            lambda: version_dimension(
                published,
                "dim_fund",
                funds.withColumn("currency_code", labels.currency_code(F.col("currency"))),
                FUND_TRACKED,
                ["ipo_date"],
                effective,
                batch,
            ),
            lambda: version_dimension(
                published,
                "dim_manager",
                published.read("investment_manager"),
                ["name", "ojk_code", "is_active"],
                [],
                effective,
                batch,
            ),
            lambda: version_dimension(
                published,
                "dim_custodian",
                published.read("custodian_bank"),
                ["name", "ownership_status"],
                [],
                effective,
                batch,
            ),
        ]
    )
    owners = funds.select(
        "fund_id",
        "manager_id",
        "bank_id",
        F.col("conservative_label").alias("label"),
        F.col("fund_type").alias("fund_type_code"),
    )
    dim_manager = published.read_side("dim_manager")
    keys = star_keys(
        owners,
        published.read_side("dim_fund"),
        dim_manager,
        published.read_side("dim_custodian"),
        published.read_side("dim_category"),
    )
    keys = lookup(keys, published.counts.get("mutual_fund", 0))
    manager_keys = current_versions(dim_manager).select("manager_id", "dim_manager_key")

    waited = published.read(WAITING.name)
    waiting, rejects = [], []

    def new_rows(source: str, fact: str, owner: str) -> DataFrame | None:
        if full or fact not in published.folders:
            return published.read(source)
        mine = waited.filter(F.col("fact") == fact)
        span = span_of(mine, "record_date")
        added = published.read_added(source)
        if span is None:
            return added
        old = published.read(source).filter(F.col("record_date").between(span[1], span[2]))
        late = old.join(
            mine.select(F.col("owner_id").alias(owner), "record_date"),
            [owner, "record_date"],
            "left_semi",
        )
        # stored, as its dates are looked up before its rows are read
        return cut_lineage(late if added is None else added.unionByName(late))

    def add_facts(
        source: str, fact: str, owner: str, owner_keys: DataFrame, measures=lambda rows, known: rows
    ) -> None:
        rows = new_rows(source, fact, owner)
        if rows is None:
            return
        known = fact in published.folders and not full
        facts = fact_rows(measures(rows, known), owner_keys, owner, "record_date")
        rejects.append(_append(published, fact, facts, batch, rows))
        unplaced = rows.join(owner_keys.select(owner), owner, "left_anti").filter(
            F.col("record_date").isNotNull()
        )
        waiting.append(
            unplaced.select(
                F.lit(fact).alias("fact"), F.col(owner).alias("owner_id"), "record_date"
            ).distinct()
        )

    def nav_measures(rows: DataFrame, known: bool) -> DataFrame:
        return nav_return(nav, rows if known else None)

    def latest() -> None:
        newest = _latest(published, nav, full)
        if newest is not None:
            published.replace("latest_nav", conform(newest, CONTRACTS["latest_nav"]), batch)

    run_together(
        [
            lambda: add_facts("nav_record", "fact_nav_daily", "fund_id", keys, nav_measures),
            lambda: add_facts("aum_record", "fact_aum_monthly", "fund_id", keys),
            lambda: add_facts(
                "manager_aum_record", "fact_manager_aum_monthly", "manager_id", manager_keys
            ),
            latest,
        ]
    )
    added = published.read_added("fact_nav_daily")
    if added is not None:
        dims = published.read("dim_category"), published.read("dim_date")
        published.append(MOMENTS.name, monthly_moments(added, *dims), batch)
    if waiting:
        seen = reduce(DataFrame.unionByName, waiting)
        published.replace(WAITING.name, seen, batch)
    if rejects:
        published.append(REJECT_LOG.name, reduce(DataFrame.unionByName, rejects), batch)


def _days(published: Published, full: bool) -> DataFrame:
    """The calendar over the prices and values, or over what is new of them and the
    days that are stored."""
    sources = ("nav_record", "aum_record")
    if full or "dim_date" not in published.folders:
        return calendar([published.read(s) for s in sources], "record_date")
    stored = published.read("dim_date").select(F.col("full_date").alias("record_date"))
    added = [published.read_added(s) for s in sources]
    return calendar([stored, *[a for a in added if a is not None]], "record_date")


def _latest(published: Published, nav: DataFrame, full: bool) -> DataFrame | None:
    """The newest price and return of each fund; None if this run adds no price.

    A fund whose added prices are newer than its stored one needs these only.  The
    history is read for funds that got an older price, and it may be their last
    but one.
    """
    order = ("record_date", "nav_value")
    if full or "latest_nav" not in published.folders:
        return latest_return(nav, ["fund_id"], *order)
    added = published.read_added("nav_record")
    if added is None:
        return None
    stored = published.read("latest_nav")
    added = added.select("fund_id", *order)
    touched = added.select("fund_id").distinct()
    older = (
        added.join(stored.select("fund_id", F.col("record_date").alias("_known")), "fund_id")
        .filter("record_date < _known")
        .select("fund_id")
        .distinct()
    )
    both = added.unionByName(stored.select("fund_id", *order).join(touched, "fund_id", "left_semi"))
    plain = both.join(older, "fund_id", "left_anti")
    newest = latest_return(plain, ["fund_id"], *order).unionByName(
        latest_return(nav.join(older, "fund_id", "left_semi"), ["fund_id"], *order)
    )
    untouched = stored.join(touched, "fund_id", "left_anti")
    return conform(newest, CONTRACTS["latest_nav"]).unionByName(untouched)


def _categories(published: Published, funds: DataFrame) -> DataFrame:
    labelled = funds.select(
        F.col("conservative_label").alias("label"), F.col("fund_type").alias("fund_type_code")
    )
    key = ["label", "fund_type_code"]
    return scd1_insert(published.read("dim_category"), labelled, key, "category_id")


def _append(
    published: Published, name: str, rows: DataFrame, batch: str, dated: DataFrame | None = None
) -> DataFrame:
    """Append the absent rows; ``dated`` gives the dates they can have, outside
    of which the stored facts need not be read.  Returns the rejected ones."""
    contract = CONTRACTS[name]
    span = None
    if dated is not None:
        span = span_of(dated.select(dates.date_key(F.col("record_date")).alias("date_id")), "date_id")
    key = list(contract.key)
    reason = first_reason(misfits(rows, contract)).alias("reject_reason")
    typed = conform(rows, contract, (), reason)
    fresh = cut_lineage(absent_rows(published.read_side(name), typed, key, span=span))
    published.append(name, accepted(fresh), batch)
    return reject_rows(rejected(fresh), name, key, batch)
