"""Rejects, domain checks, duplicates, orphans and portfolio sums."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.operators import quality
from dimflow.operators.cascade import Link, sweep
from dimflow.operators.rules import Rules, broken_rules
from dimflow.plans.delete import deleted_counts
from dimflow.sources.published import table_counts as counts_of
from workload.tables import Tables, query

ALL_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


@query(
    """
    SELECT c_custkey, CASE WHEN c_custkey = 0 THEN 'placeholder'
                           WHEN c_nationkey = 0 THEN 'no value'
                           WHEN c_acctbal <= 0 THEN 'value not positive'
                           WHEN c_mktsegment = 'MACHINERY' THEN 'no date' END AS reject_reason
    FROM customer
    """
)
def valid_series_with_rejects(t):
    value = F.when(F.col("c_nationkey") != 0, F.col("c_acctbal"))
    dated = F.when(F.col("c_mktsegment") != "MACHINERY", F.lit("2024-01-01"))
    rows = t.customer.select("c_custkey", value.alias("value"), dated.alias("dated"))
    marked = quality.mark_rejects(
        rows,
        {
            "placeholder": F.col("c_custkey") == 0,
            "no value": F.col("value").isNull(),
            "value not positive": F.col("value") <= 0,
            "no date": F.col("dated").isNull(),
        },
    )
    return marked.select("c_custkey", "reject_reason")


@query(
    """
    SELECT reject_reason, CAST(COUNT(*) AS BIGINT) AS n_rows
    FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN 'no value'
                      WHEN o_totalprice > 400000 THEN 'too large' END AS reject_reason FROM orders)
    WHERE reject_reason IS NOT NULL GROUP BY 1
    """
)
def reject_counts(t):
    marked = quality.mark_rejects(
        t.orders,
        {
            "no value": F.col("o_orderstatus") == "P",
            "too large": F.col("o_totalprice") > 400000,
        },
    )
    return quality.reject_counts(marked)


@query(
    """
    SELECT c_custkey, UNNEST(LIST_FILTER([
        CASE WHEN c_acctbal < 0 THEN 'balance not negative' END,
        CASE WHEN c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD', 'FURNITURE')
             THEN 'segment known' END,
        CASE WHEN LENGTH(c_name || c_mktsegment) > 27 THEN 'name fits 27' END,
        CASE WHEN ABS(c_acctbal) >= 1000 THEN 'balance fits (5,2)' END],
        lambda x: x IS NOT NULL)) AS violation
    FROM customer
    """
)
def domain_violations(t):
    checks = {
        "balance not negative": F.col("c_acctbal") >= 0,
        "segment known": F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD", "FURNITURE"),
        "name fits 27": quality.fits_width(F.concat("c_name", "c_mktsegment"), 27),
        "balance fits (5,2)": quality.fits_decimal(F.col("c_acctbal"), 5, 2),
    }
    return quality.violations(t.customer, ["c_custkey"], checks)


@query(
    """
    SELECT l_orderkey, l_linenumber, CAST(COUNT(*) AS BIGINT) AS n_rows
    FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1
    """
)
def duplicate_keys(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT o_custkey, CAST(COUNT(*) AS BIGINT) AS n_rows FROM orders
    WHERE o_orderstatus = 'O' GROUP BY 1 HAVING COUNT(*) > 1
    """
)
def duplicate_open_keys(t):
    """Uniqueness within part of the table, as of one current version per key."""
    return quality.duplicate_keys(t.orders, ["o_custkey"], F.col("o_orderstatus") == "O")


@query(
    """
    SELECT l_orderkey, CAST(COUNT(*) AS BIGINT) AS n_rows FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1
    """
)
def orphan_rows(t):
    parents = t.orders.filter("o_orderstatus <> 'P'")
    return quality.orphans(t.lineitem, ["l_orderkey"], parents, ["o_orderkey"])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1997-01-01')
    """
)
def cascade_children(t):
    surviving = t.orders.filter("o_orderdate >= '1997-01-01'")
    parents = surviving.select(F.col("o_orderkey").alias("l_orderkey"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return quality.children_of(rows, ["l_orderkey"], parents)


TREE = [
    Link("nation", "n_regionkey", "region", "r_regionkey"),
    Link("customer", "c_nationkey", "nation", "n_nationkey"),
    Link("supplier", "s_nationkey", "nation", "n_nationkey"),
    Link("orders", "o_custkey", "customer", "c_custkey"),
    Link("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Link("lineitem", "l_suppkey", "supplier", "s_suppkey"),
]


@query(
    """
    WITH n AS (SELECT n_nationkey FROM nation WHERE n_regionkey IN (2, 4)),
    c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT * FROM n)),
    s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT * FROM n)),
    o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT * FROM c)),
    flags AS (
        SELECT 'region' AS table_name, r_regionkey IN (2, 4) AS gone FROM region
        UNION ALL SELECT 'nation', n_regionkey IN (2, 4) FROM nation
        UNION ALL SELECT 'customer', c_nationkey IN (SELECT * FROM n) FROM customer
        UNION ALL SELECT 'supplier', s_nationkey IN (SELECT * FROM n) FROM supplier
        UNION ALL SELECT 'orders', o_custkey IN (SELECT * FROM c) FROM orders
        UNION ALL SELECT 'lineitem', l_orderkey IN (SELECT * FROM o) OR l_suppkey IN (SELECT * FROM s)
        FROM lineitem)
    SELECT table_name, CAST(COUNT(*) FILTER (gone) AS BIGINT) AS n_deleted,
           CAST(COUNT(*) FILTER (NOT gone) AS BIGINT) AS n_left
    FROM flags GROUP BY 1
    """
)
def cascade_levels(t):
    """Two regions are deleted and all that hangs on them, over four levels; lines go
    with their order or with their supplier."""
    keys = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
            "supplier": "s_suppkey", "orders": "o_orderkey", "lineitem": "l_linenumber"}
    tables = {}
    for name, key in keys.items():
        used = {key, *[link.column for link in TREE if link.child == name]}
        tables[name] = getattr(t, name).select(*sorted(used))
    start = t.region.filter("r_regionkey IN (2, 4)").select("r_regionkey")
    return deleted_counts(sweep(tables, TREE, "region", start))


@query(
    """
    WITH broken AS (
        SELECT 'orders' AS table_name, 'total not small' AS rule, COUNT(*) AS n
        FROM orders WHERE NOT o_totalprice >= 50000
        UNION ALL SELECT 'orders', 'status is O or F', COUNT(*)
        FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
        UNION ALL SELECT 'orders', 'unique day of customer', SUM(n) FROM (
            SELECT COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderdate HAVING COUNT(*) > 1)
        UNION ALL SELECT 'orders', 'one open order', SUM(n) FROM (
            SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey
            HAVING COUNT(*) > 1)
        UNION ALL SELECT 'orders', 'o_custkey in customer', COUNT(*) FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
        UNION ALL SELECT 'lineitem', 'l_partkey in part', COUNT(*) FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 45)
        UNION ALL SELECT 'lineitem', 'l_orderkey in orders', COUNT(*) FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'lineitem', 'quantity below 45', COUNT(*) FROM lineitem WHERE l_quantity >= 45
        UNION ALL SELECT 'part', 'unique name', SUM(n) FROM (
            SELECT COUNT(*) AS n FROM part WHERE p_size < 45 GROUP BY p_name HAVING COUNT(*) > 1))
    SELECT table_name, rule, CAST(n AS BIGINT) AS n_rows FROM broken WHERE n > 0
    """
)
def rules_in_one_scan(t):
    """Checks, unique keys and foreign keys of four tables, each of them read once."""
    tables = {
        "customer": t.customer.filter("c_acctbal > 0"),
        "part": t.part.filter("p_size < 45"),
        "orders": t.orders,
        "lineitem": t.lineitem,
    }
    rules = {
        "part": Rules(unique={"unique name": (["p_name"], None)}),
        "orders": Rules(
            checks={
                "total not small": F.col("o_totalprice") >= 50000,
                "status is O or F": F.col("o_orderstatus").isin("O", "F"),
            },
            unique={
                "unique day of customer": (["o_custkey", "o_orderdate"], None),
                "one open order": (["o_custkey"], F.col("o_orderstatus") == "P"),
            },
            parents={"o_custkey": ("customer", "c_custkey")},
        ),
        "lineitem": Rules(
            checks={"quantity below 45": F.col("l_quantity") < 45},
            parents={"l_partkey": ("part", "p_partkey"), "l_orderkey": ("orders", "o_orderkey")},
        ),
    }
    return broken_rules(tables, rules)


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n_rows FROM {name}"
        for name in ALL_TABLES
    )
)
def table_counts(t):
    return counts_of({name: getattr(t, name) for name in ALL_TABLES})


def portfolio(t: Tables):
    """Orders as portfolios: lines of one flag allocate, the others are holdings."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        "l_returnflag",
        F.col("l_quantity").cast("decimal(18,4)").alias("value_pct"),
    )
    return (
        t.orders.select("o_orderkey"),
        lines.filter("l_returnflag = 'A'"),
        lines.filter("l_returnflag <> 'A'"),
    )


SUMS_SQL = """
    SELECT l_orderkey, SUM(l_quantity) FILTER (l_returnflag = 'A') AS allocation_sum,
           SUM(l_quantity) FILTER (l_returnflag <> 'A') AS holding_sum
    FROM lineitem GROUP BY 1
"""


@query(
    f"""
    SELECT * FROM (
        SELECT o_orderkey, COALESCE(allocation_sum, 0) AS allocation_sum,
               COALESCE(holding_sum, 0) AS holding_sum,
               ABS(COALESCE(allocation_sum, 0) - 100) > 5 AS allocation_off,
               COALESCE(holding_sum, 0) > 100 AS holding_over
        FROM orders LEFT JOIN ({SUMS_SQL}) ON l_orderkey = o_orderkey)
    WHERE allocation_off OR holding_over
    """
)
def portfolio_sum_anomalies(t):
    found = quality.sum_anomalies(*portfolio(t), ["o_orderkey"], "value_pct")
    sums = ("allocation_sum", "holding_sum")
    return found.withColumns({c: F.col(c).cast("double") for c in sums})


@query(
    f"""
    SELECT CAST(COUNT(allocation_sum) AS BIGINT) AS allocation_snapshots,
           CAST(COUNT(*) FILTER (ABS(allocation_sum - 100) > 5) AS BIGINT) AS allocation_off,
           CAST(COUNT(*) FILTER (ABS(allocation_sum - 100) <= 5) AS BIGINT) AS allocation_near_full,
           CAST(COUNT(holding_sum) AS BIGINT) AS holding_snapshots,
           MIN(holding_sum) AS holding_min, MAX(holding_sum) AS holding_max
    FROM ({SUMS_SQL})
    """
)
def portfolio_checkpoint(t):
    _, allocations, holdings = portfolio(t)
    found = quality.sum_checkpoint(allocations, holdings, ["o_orderkey"], "value_pct")
    ends = ("holding_min", "holding_max")
    return found.withColumns({c: F.col(c).cast("double") for c in ends})
