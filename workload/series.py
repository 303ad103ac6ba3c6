"""Time series and report queries."""

from __future__ import annotations

import hashlib
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.functions import labels
from dimflow.functions.dates import date_key
from dimflow.operators.dedup import last_per_key, latest_per_key as newest_per_key
from dimflow.operators.quality import fingerprint
from dimflow.operators.series import batch_coverage as coverage
from dimflow.operators.series import benchmark_return as benchmark_returns
from dimflow.operators.series import latest_return
from dimflow.operators.series import period_return as returns_of
from dimflow.plans import reports
from dimflow.plans.mart import calendar
from dimflow.session import cut_lineage, shared_folder
from dimflow.sources.published import Published
from workload.tables import Tables, cents, day, query, rounded

SLOT = "week"  # the events span one month

DAILY_SQL = """
    SELECT user_id AS fund_id, CAST(ts AS DATE) AS record_date,
           SUM(CAST(ROUND(value, 2) AS DECIMAL(18, 2))) AS nav_value
    FROM events GROUP BY 1, 2
"""
RETURN_SQL = f"""
    SELECT fund_id, record_date, CAST(nav_value AS DOUBLE) AS nav_value,
           CAST(LAG(nav_value) OVER w AS DOUBLE) AS prev_nav_value,
           CAST(nav_value - LAG(nav_value) OVER w AS DOUBLE)
             / NULLIF(CAST(LAG(nav_value) OVER w AS DOUBLE), 0) AS daily_return
    FROM ({DAILY_SQL}) WINDOW w AS (PARTITION BY fund_id ORDER BY record_date)
"""


def daily_values(t: Tables) -> DataFrame:
    return t.events.groupBy(F.col("user_id").alias("fund_id"), day("ts").alias("record_date")).agg(
        F.sum(cents("value")).cast("decimal(18,4)").alias("nav_value")
    )


def daily_returns(t: Tables) -> DataFrame:
    keys = ["fund_id"]
    return returns_of(
        daily_values(t), keys, "record_date", "nav_value", "prev_nav_value", slot=SLOT
    )


def monthly_amounts(t: Tables) -> DataFrame:
    month = F.trunc(day("o_orderdate"), "month")
    return t.orders.groupBy(F.col("o_custkey").alias("fund_id"), month.alias("record_date")).agg(
        F.floor(F.sum(cents("o_totalprice"))).cast("bigint").alias("aum_value"),
        F.count("*").alias("total_units"),
    )


MONTHLY_SQL = """
    SELECT o_custkey AS fund_id, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS record_date,
           CAST(FLOOR(SUM(CAST(ROUND(o_totalprice, 2) AS DECIMAL(18, 2)))) AS BIGINT) AS aum_value,
           COUNT(*) AS total_units
    FROM orders GROUP BY 1, 2
"""


@query(
    f"""
    SELECT fund_id, record_date, ROUND(nav_value, 2) AS nav_value,
           ROUND(prev_nav_value, 2) AS prev_nav_value, ROUND(daily_return, 6) AS daily_return
    FROM ({RETURN_SQL})
    """
)
def period_return(t):
    return daily_returns(t).select(
        "fund_id",
        "record_date",
        rounded("nav_value", 2),
        rounded("prev_nav_value", 2),
        rounded("daily_return"),
    )


@query(
    """
    SELECT benchmark_id, record_date, ROUND(CAST(value AS DOUBLE), 2) AS value,
           ROUND(CAST(value - LAG(value) OVER w AS DOUBLE)
             / NULLIF(CAST(LAG(value) OVER w AS DOUBLE), 0), 6) AS daily_return
    FROM (SELECT event_type AS benchmark_id, CAST(ts AS DATE) AS record_date,
                 SUM(CAST(ROUND(value, 2) AS DECIMAL(18, 2))) AS value
          FROM events GROUP BY 1, 2)
    WINDOW w AS (PARTITION BY benchmark_id ORDER BY record_date)
    """
)
def benchmark_return(t):
    points = t.events.groupBy(
        F.col("event_type").alias("benchmark_id"), day("ts").alias("record_date")
    ).agg(F.sum(cents("value")).cast("decimal(18,4)").alias("value"))
    returns = benchmark_returns(points, slot=SLOT)
    return returns.select("benchmark_id", "record_date", rounded("value", 2), rounded("daily_return"))


@query(
    """
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice
    FROM orders
    QUALIFY ROW_NUMBER() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """
)
def latest_per_key(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    newest = last_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return newest.withColumn("o_orderdate", day("o_orderdate"))


@query(
    f"""
    SELECT fund_id, MAX(record_date) AS record_date,
           ROUND(CAST(ARG_MAX(nav_value, record_date) AS DOUBLE), 2) AS nav_value
    FROM ({DAILY_SQL}) GROUP BY 1
    """
)
def latest_value_per_key(t):
    newest = newest_per_key(daily_values(t), ["fund_id"], "record_date", ["nav_value"])
    return newest.select("fund_id", "record_date", rounded("nav_value", 2))


LATEST_RETURN_SQL = f"""
    SELECT fund_id, record_date, ROUND(nav_value, 2) AS nav_value,
           ROUND(daily_return, 6) AS daily_return
    FROM ({RETURN_SQL})
    QUALIFY ROW_NUMBER() OVER (PARTITION BY fund_id ORDER BY record_date DESC) = 1
"""


@query(LATEST_RETURN_SQL)
def latest_return_per_key(t):
    newest = latest_return(daily_values(t), ["fund_id"], "record_date", "nav_value")
    return newest.select("fund_id", "record_date", rounded("nav_value", 2), rounded("daily_return"))


@query(LATEST_RETURN_SQL + " ORDER BY fund_id")
def persisted_latest(t):
    """The same rows through a stored table, which a dashboard reads."""
    return cut_lineage(latest_return_per_key(t)).orderBy("fund_id")


@query(
    f"""
    SELECT c_nationkey AS class_group_id, record_date,
           CAST(SUM(aum_value) AS BIGINT) AS class_total_aum,
           CAST(SUM(total_units) AS BIGINT) AS class_total_unit,
           CAST(COUNT(*) AS BIGINT) AS n_classes
    FROM ({MONTHLY_SQL}) JOIN customer ON fund_id = c_custkey
    WHERE c_nationkey <> 0 GROUP BY 1, 2
    """
)
def group_totals(t):
    members = t.customer.select(
        F.col("c_custkey").alias("fund_id"),
        F.nullif("c_nationkey", F.lit(0)).alias("class_group_id"),
    )
    totals = reports.class_totals(members, monthly_amounts(t))
    whole = ["class_total_aum", "class_total_unit"]
    return totals.withColumns({c: F.col(c).cast("bigint") for c in whole})


@query(
    f"""
    SELECT a.fund_id, a.record_date, LAST_DAY(a.record_date) AS published_date, a.total_units,
           ROUND(a.aum_value / n.nav_value, 4) AS derived_units,
           ROUND(ABS(a.total_units - a.aum_value / n.nav_value), 4) AS units_gap
    FROM ({MONTHLY_SQL}) a
    LEFT JOIN (
        SELECT o_custkey AS fund_id, CAST(o_orderdate AS DATE) AS record_date,
               CAST(SUM(CAST(ROUND(o_totalprice, 2) AS DECIMAL(18, 2))) AS DOUBLE)
                 / COUNT(*) AS nav_value
        FROM orders GROUP BY 1, 2) n
      ON n.fund_id = a.fund_id AND n.record_date = LAST_DAY(a.record_date)
    """
)
def unit_integrity(t):
    aum = monthly_amounts(t).withColumn("published_date", F.last_day("record_date"))
    mean = F.sum(cents("o_totalprice")).cast("double") / F.count("*")
    nav = t.orders.groupBy(
        F.col("o_custkey").alias("fund_id"), day("o_orderdate").alias("record_date")
    ).agg(mean.alias("nav_value"))
    checked = reports.unit_integrity(aum.withColumn("aum_value", F.col("aum_value") * 1.0), nav)
    return checked.withColumns(
        {c: F.round(c, 4) for c in ("derived_units", "units_gap")}
    )


def volatility_facts(t):
    """Daily returns with their category, the categories, and the days."""
    returns = daily_returns(t).withColumn("daily_return", F.col("daily_return").cast("double"))
    owners = t.customer.select(
        F.col("c_custkey").alias("fund_id"), F.col("c_mktsegment").alias("category_id")
    )
    facts = returns.join(owners, "fund_id").withColumn(
        "date_id", date_key(F.col("record_date"))
    )
    categories = t.customer.select(
        F.col("c_mktsegment").alias("category_id"), F.col("c_mktsegment").alias("label")
    ).distinct()
    days = calendar([t.events.select(day("ts").alias("record_date"))], "record_date")
    return facts, categories, days


VOLATILITY_SQL = f"""
    SELECT c_mktsegment AS label, CAST(COUNT(DISTINCT fund_id) AS BIGINT) AS n_fund,
           ROUND(STDDEV_SAMP(daily_return) * SQRT(252), 4) AS ann_volatility,
           ROUND(AVG(daily_return) * 252, 4) AS ann_return
    FROM ({RETURN_SQL}) JOIN customer ON fund_id = c_custkey
    WHERE YEAR(record_date) = 2024 GROUP BY 1
    """


@query(VOLATILITY_SQL)
def category_volatility(t):
    report = reports.category_volatility(*volatility_facts(t), 2024)
    return report.withColumns({c: F.round(c, 4) for c in ("ann_volatility", "ann_return")})


@query(VOLATILITY_SQL)
def volatility_from_moments(t):
    """From the stored states of two batches, of days in turn, so that every month is
    in both."""
    facts, categories, days = volatility_facts(t)
    root = f"{shared_folder(t.spark)}/{uuid4().hex}"
    facts = cut_lineage(facts)
    for batch in (0, 1):
        published = Published(t.spark, root)
        mine = facts.filter(F.col("date_id") % 2 == batch)
        states = reports.monthly_moments(mine, categories, days)
        published.append("category_moments", states, f"b{batch}")
        published.publish(f"b{batch}")
    stored = Published(t.spark, root).read("category_moments")
    report = reports.volatility_of_moments(stored, 2024)
    return report.withColumns({c: F.round(c, 4) for c in ("ann_volatility", "ann_return")})


@query(
    """
    SELECT CAST(ts AS DATE) AS record_date, CAST(COUNT(*) AS BIGINT) AS n_rows,
           STRFTIME(MIN(ts), '%Y-%m-%d %H:%M:%S') AS first_batch,
           STRFTIME(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_batch
    FROM events GROUP BY 1 ORDER BY 1 DESC LIMIT 10
    """
)
def batch_coverage(t):
    covered = coverage(t.events.withColumn("record_date", day("ts")), "record_date", "ts")
    shown = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first_batch", "last_batch")}
    return covered.withColumns(shown)


@query(
    """
    SELECT c_name AS name, CAST(o_orderdate AS DATE) AS date_based, l_quantity AS value_pct
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
    WHERE MD5('P' || p_partkey) = MD5('P17')
    """
)
def instrument_lookup(t):
    code = F.md5(F.concat(F.lit("P"), F.col("p_partkey").cast("string")))
    return reports.holders_of(
        hashlib.md5(b"P17").hexdigest(),
        t.part.select(F.col("p_partkey").alias("security_id"), code.alias("code")),
        t.lineitem.select(
            F.col("l_orderkey").alias("snapshot_id"),
            F.col("l_partkey").alias("security_id"),
            F.col("l_quantity").alias("value_pct"),
        ),
        t.orders.select(
            F.col("o_orderkey").alias("snapshot_id"),
            F.col("o_custkey").alias("fund_id"),
            day("o_orderdate").alias("date_based"),
        ),
        t.customer.select(F.col("c_custkey").alias("fund_id"), F.col("c_name").alias("name")),
    )


@query(
    """
    SELECT CAST(COUNT(*) AS BIGINT) AS n_rows,
           CAST(SUM(CAST('0x' || SUBSTR(h, 1, 16) AS UBIGINT)) AS VARCHAR) || '-'
             || CAST(SUM(CAST('0x' || SUBSTR(h, 17, 16) AS UBIGINT)) AS VARCHAR) AS digest
    FROM (SELECT MD5(ARRAY_TO_STRING(LIST_TRANSFORM([
        CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus,
        CAST(CAST(ROUND(o_totalprice * 100) AS BIGINT) AS VARCHAR),
        STRFTIME(o_orderdate, '%Y-%m-%d'), o_orderpriority],
        lambda f: COALESCE(LENGTH(f) || ':' || f, '-')), '|')) AS h FROM orders)
    """
)
def result_fingerprint(t):
    columns = [
        F.col("o_orderkey"),
        F.col("o_custkey"),
        F.col("o_orderstatus"),
        F.round(F.col("o_totalprice") * 100).cast("bigint"),
        day("o_orderdate"),
        F.col("o_orderpriority"),
    ]
    return fingerprint(t.orders, columns)


@query(
    """
    SELECT c_mktsegment, CASE c_nationkey WHEN 0 THEN 'IDR' ELSE 'USD' END AS currency_code,
           CAST(SUM(CAST(ROUND(o_totalprice, 2) AS DECIMAL(18, 2))) AS DOUBLE) AS total,
           CAST(COUNT(*) AS BIGINT) AS n_rows
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
    """
)
def totals_by_currency(t):
    owners = t.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        "c_mktsegment",
        labels.currency_code(F.col("c_nationkey")).alias("currency_code"),
    )
    amounts = t.orders.select("o_custkey", cents("o_totalprice").alias("amount"))
    totals = reports.totals_by_currency(
        amounts.join(owners, "o_custkey"), "currency_code", "amount", ["c_mktsegment"]
    )
    return totals.withColumn("total", F.col("total").cast("double"))
