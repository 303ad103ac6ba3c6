"""Write modes, keys and deduplication over two states of the driver's tables."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import functions as F

from dimflow.operators import merge
from dimflow.operators.dedup import first_per_key, last_per_key
from dimflow.operators.keys import number_absent, number_rows, resolve_keys
from dimflow.plans.load import load
from dimflow.plans.transform import Clean
from dimflow.session import shared_folder
from dimflow.sources.published import Published
from workload.tables import cents, day, query


def buyer_states(t, where: str):
    """What the orders of a period say about each customer."""
    return (
        t.orders.filter(where)
        .groupBy("o_custkey")
        .agg(
            F.floor(F.sum(cents("o_totalprice")) / 1000000).cast("int").alias("tier"),
            F.max(day("o_orderdate")).alias("last_order"),
            F.count("*").alias("n_orders"),
        )
    )


EARLY, LATE = "o_orderdate < '1999-01-01'", "o_orderdate >= '1998-01-01'"
STATE_SQL = """
    SELECT o_custkey, CAST(FLOOR(SUM(CAST(ROUND(o_totalprice, 2) AS DECIMAL(18, 2)))
             / 1000000) AS INTEGER) AS tier,
           CAST(MAX(o_orderdate) AS DATE) AS last_order, CAST(COUNT(*) AS BIGINT) AS n_orders
    FROM orders WHERE {where} GROUP BY 1
"""
OLD_SQL, NEW_SQL = STATE_SQL.format(where=EARLY), STATE_SQL.format(where=LATE)


@query(
    f"""
    SELECT COALESCE(n.o_custkey, o.o_custkey) AS o_custkey,
           CASE WHEN n.o_custkey IS NULL THEN o.tier ELSE n.tier END AS tier,
           CASE WHEN n.o_custkey IS NULL THEN o.last_order ELSE n.last_order END AS last_order,
           o.n_orders
    FROM ({OLD_SQL}) o FULL JOIN ({NEW_SQL}) n ON o.o_custkey = n.o_custkey
    """
)
def upsert(t):
    """The new state does not carry ``n_orders``; the old value stays."""
    old, new = buyer_states(t, EARLY), buyer_states(t, LATE).drop("n_orders")
    return merge.upsert(old, new, ["o_custkey"])


@query(
    """
    WITH old AS (
        SELECT o_custkey, o_orderdate, MIN(o_orderkey) AS o_orderkey FROM orders
        WHERE o_orderdate < DATE '1998-01-01' GROUP BY 1, 2),
    new AS (
        SELECT o_custkey, o_orderdate, MAX(o_orderkey) AS o_orderkey FROM orders
        WHERE o_orderdate >= DATE '1997-01-01' GROUP BY 1, 2)
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey FROM old
    UNION ALL
    SELECT o_custkey, CAST(o_orderdate AS DATE), o_orderkey FROM new
    ANTI JOIN old USING (o_custkey, o_orderdate)
    """
)
def insert_if_absent(t):
    """The periods overlap by a year, in which the old rows stand."""
    key = ["o_custkey", "o_orderdate"]
    rows = t.orders.select(*key[:1], day("o_orderdate").alias("o_orderdate"), "o_orderkey")
    old = rows.filter("o_orderdate < '1998-01-01'").groupBy(*key)
    old = old.agg(F.min("o_orderkey").alias("o_orderkey"))
    new = rows.filter("o_orderdate >= '1997-01-01'")
    order = [F.desc("o_orderkey")]
    return merge.insert_if_absent(old, new, key, order, merge.span_of(new, "o_orderdate"))


@query(
    """
    WITH new AS (SELECT * FROM lineitem WHERE l_shipdate >= DATE '2000-01-01')
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS l_shipdate FROM new
    UNION ALL
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) FROM lineitem
    WHERE l_shipdate < DATE '2000-06-01' AND l_orderkey NOT IN (SELECT l_orderkey FROM new)
    """
)
def replace_children(t):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", day("l_shipdate").alias("l_shipdate")]
    rows = t.lineitem.select(*columns)
    old, new = rows.filter("l_shipdate < '2000-06-01'"), rows.filter("l_shipdate >= '2000-01-01'")
    return merge.replace_children(old, new, "l_orderkey")


@query(
    """
    SELECT l_orderkey, l_partkey, SUM(l_quantity) AS l_quantity,
           ARG_MIN(l_suppkey, (l_linenumber, l_suppkey, l_extendedprice)) AS l_suppkey
    FROM lineitem GROUP BY 1, 2
    """
)
def merge_duplicate_lines(t):
    rows = t.lineitem.select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").cast("decimal(18,4)").alias("l_quantity"),
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
    )
    order = ["l_linenumber", "l_suppkey", "l_extendedprice"]
    merged = merge.sum_duplicates(rows, ["l_orderkey", "l_partkey"], "l_quantity", order)
    quantity = F.col("l_quantity").cast("double").alias("l_quantity")
    return merged.select("l_orderkey", "l_partkey", quantity, "l_suppkey")


@query(
    """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
    QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
    """
)
def first_wins(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    order = [F.col("o_orderdate"), F.col("o_orderkey")]
    return first_per_key(rows, ["o_custkey"], order).withColumn("o_orderdate", day("o_orderdate"))


@query(
    """
    SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey
        ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1
    """
)
def last_wins(t):
    rows = t.lineitem.select(
        "l_partkey", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    return last_per_key(rows, ["l_partkey", "l_suppkey"], order).drop("l_shipdate")


@query(
    """
    WITH known AS (
        SELECT p_name, p_brand, ROW_NUMBER() OVER (ORDER BY p_name, p_brand) AS security_id
        FROM (SELECT DISTINCT p_name, p_brand FROM part WHERE p_size <= 25)),
    fresh AS (
        SELECT DISTINCT p_name, p_brand FROM part ANTI JOIN known USING (p_name, p_brand))
    SELECT * FROM known
    UNION ALL
    SELECT p_name, p_brand, ROW_NUMBER() OVER (ORDER BY p_name, p_brand)
             + (SELECT COALESCE(MAX(security_id), 0) FROM known)
    FROM fresh
    """
)
def assign_surrogate_keys(t):
    key = ["p_name", "p_brand"]
    known = number_rows(t.part.filter("p_size <= 25").select(*key).distinct(), key, "security_id")
    fresh = number_absent(known, t.part.select(*key).distinct(), key, "security_id")
    return known.unionByName(fresh)


@query(
    """
    WITH known AS (
        SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS snapshot_id
        FROM orders WHERE o_orderstatus <> 'P')
    SELECT l_orderkey AS o_orderkey, snapshot_id, CAST(COUNT(*) AS BIGINT) AS n_lines
    FROM lineitem LEFT JOIN known ON l_orderkey = o_orderkey GROUP BY 1, 2
    """
)
def resolve_parent_keys(t):
    parents = t.orders.filter("o_orderstatus <> 'P'").select("o_orderkey")
    key_map = number_rows(parents, ["o_orderkey"], "snapshot_id")
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    resolved = resolve_keys(lines, key_map, ["o_orderkey"], "snapshot_id")
    return resolved.groupBy("o_orderkey", "snapshot_id").agg(F.count("*").alias("n_lines"))


@query(
    """
    SELECT CAST(c_custkey AS INTEGER) AS manager_id,
           CASE WHEN c_custkey % 10 = 0 THEN c_name || ' renamed' ELSE c_name END AS name,
           c_acctbal >= 0 AS is_active, CAST(c_custkey % 10 = 0 AS BIGINT) AS n_changes
    FROM customer WHERE c_custkey % 7 <> 3
    """
)
def load_with_audit(t):
    """The load plan over stored clean rows, run for two batches, as another reader
    sees the published result.  A row without a code is rejected, and a renamed one
    leaves an audit row."""
    root = f"{shared_folder(t.spark)}/{uuid4().hex}"
    number = F.col("c_custkey")
    first = t.customer.select(
        number.alias("manager_id"),
        F.col("c_name").alias("name"),
        F.when(number % 7 != 3, F.col("c_mktsegment")).alias("ojk_code"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )
    renamed = F.when(F.col("manager_id") % 10 == 0, F.concat("name", F.lit(" renamed")))
    second = first.withColumn("name", F.coalesce(renamed, "name"))
    for n, rows in enumerate((first, second), 1):
        batch = f"day{n}"
        clean = Clean(t.spark, f"{root}/clean/{batch}")
        clean.save("investment_manager", rows)
        published = Published(t.spark, f"{root}/published")
        load(published, clean, ["investment_manager"], batch, datetime(2024, 2, n))
        published.publish(batch)
    seen = Published(t.spark, f"{root}/published")
    changes = seen.read("audit_log").groupBy(F.col("record_pk").cast("int").alias("manager_id")).agg(
        F.count("*").alias("n_changes")
    )
    managers = seen.read("investment_manager").select("manager_id", "name", "is_active")
    return managers.join(changes, "manager_id", "left").fillna({"n_changes": 0})


RETURNS_SQL = """
    SELECT o_custkey, o_orderdate, SUM(CAST(ROUND(o_totalprice, 2) AS DECIMAL(18, 2))) AS amount
    FROM orders WHERE {where} AND o_orderkey <> 0 GROUP BY 1, 2
"""


@query(
    f"""
    WITH old AS ({RETURNS_SQL.format(where=EARLY)}), new AS ({RETURNS_SQL.format(where=LATE)}),
    now AS (SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (o_custkey, o_orderdate))
    SELECT CAST(o_custkey AS INTEGER) AS fund_id, CAST(o_orderdate AS DATE) AS as_of_date,
           CAST(amount * 100 AS BIGINT) AS cents,
           CASE WHEN o_orderdate >= DATE '1998-01-01' THEN 'second' ELSE 'first' END AS written_by
    FROM now
    """
)
def upsert_touched_slices(t):
    """A dated table is loaded twice; the second batch writes the months it touches
    and leaves the folders of the others."""
    root = f"{shared_folder(t.spark)}/{uuid4().hex}"
    for n, where in enumerate((EARLY, LATE)):
        amount = F.sum(cents("o_totalprice")) / 1000000
        rows = t.orders.filter(where).filter("o_orderkey <> 0").groupBy("o_custkey", "o_orderdate")
        rows = rows.agg(amount.alias("return_pct")).select(
            F.col("o_custkey").alias("fund_id"),
            F.lit(1).alias("period_code"),
            day("o_orderdate").alias("as_of_date"),
            "return_pct",
            F.lit(None).cast("double").alias("treynor_ratio"),
        )
        batch = ("first", "second")[n]
        clean = Clean(t.spark, f"{root}/clean/{batch}")
        clean.save("fund_performance", rows)
        published = Published(t.spark, f"{root}/published")
        load(published, clean, ["fund_performance"], batch, datetime(2024, 2, 1 + n))
        published.publish(batch)
    parts = Published(t.spark, f"{root}/published").slices["fund_performance"]
    writers = {m: "second" if "-second-" in folder else "first" for m, (folder, _) in parts.items()}
    months = t.spark.createDataFrame(list(writers.items()), "month string, written_by string")
    found = Published(t.spark, f"{root}/published").read("fund_performance")
    found = found.withColumn("month", F.date_format("as_of_date", "yyyy-MM")).join(months, "month")
    whole = (F.col("return_pct") * 100000000).cast("bigint").alias("cents")
    return found.select("fund_id", "as_of_date", whole, "written_by")
