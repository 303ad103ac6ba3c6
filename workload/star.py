"""Calendar and facts of a star schema over customers, nations and regions."""

from __future__ import annotations

from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import functions as F

from dimflow.contracts import CONTRACTS, conform
from dimflow.operators.history import scd2_merge
from dimflow.operators.keys import number_rows
from dimflow.operators.merge import insert_if_absent
from dimflow.plans import mart
from dimflow.plans.load import load
from dimflow.plans.refresh import run_stages
from dimflow.plans.transform import Clean
from dimflow.session import cut_lineage, empty_table, run_together, shared_folder
from dimflow.sources.published import Published
from workload.series import MONTHLY_SQL, RETURN_SQL, daily_returns, monthly_amounts
from workload.tables import cents, day, query, rounded

LOAD_DAY = date(2024, 2, 1)


@query(
    """
    SELECT CAST(STRFTIME(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS full_date,
           CAST(DAY(d) AS SMALLINT) AS day, DAYNAME(d) AS day_name,
           CAST(WEEKOFYEAR(d) AS SMALLINT) AS week, CAST(MONTH(d) AS SMALLINT) AS month,
           MONTHNAME(d) AS month_name, CAST(QUARTER(d) AS SMALLINT) AS quarter,
           CAST(YEAR(d) AS SMALLINT) AS year, ISODOW(d) <= 5 AS is_weekday
    FROM (SELECT UNNEST(GENERATE_SERIES(
        (SELECT LEAST(MIN(CAST(ts AS DATE)),
                      (SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders)) FROM events),
        (SELECT GREATEST(MAX(CAST(ts AS DATE)),
                         (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders)) FROM events),
        INTERVAL 1 DAY)) AS d)
    """
)
def dim_calendar(t):
    series = [
        t.events.select(day("ts").alias("record_date")),
        t.orders.select(day("o_orderdate").alias("record_date")),
    ]
    return mart.calendar(series, "record_date")


def _versions(t, source, key: str, tracked: list[str], surrogate: str):
    columns = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in (key, *tracked)]
    shape = ", ".join(
        [f"{surrogate} bigint", *columns, "valid_from date, valid_to date, is_current boolean"]
    )
    empty = empty_table(t.spark, shape)
    return scd2_merge(empty, source, [key], tracked, [], LOAD_DAY, surrogate)


def star_keys(t):
    """Keys of the current versions per customer."""
    funds = t.customer.select(
        F.col("c_custkey").alias("fund_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("manager_id"),
        F.col("c_mktsegment").alias("label"),
        F.when(F.col("c_acctbal") < 0, 0).otherwise(1).alias("fund_type_code"),
    )
    managers = t.nation.select(F.col("n_nationkey").alias("manager_id"), "n_name", "n_regionkey")
    custodians = t.region.select(F.col("r_regionkey").alias("bank_id"), "r_name")
    owners = funds.join(
        managers.select("manager_id", F.col("n_regionkey").alias("bank_id")), "manager_id"
    )
    category = ["label", "fund_type_code"]
    dimensions = run_together(
        [
            lambda: _versions(t, funds, "fund_id", ["name"], "dim_fund_key"),
            lambda: _versions(t, managers, "manager_id", ["n_name"], "dim_manager_key"),
            lambda: _versions(t, custodians, "bank_id", ["r_name"], "dim_custodian_key"),
            lambda: number_rows(funds.select(*category).distinct(), category, "category_id"),
        ]
    )
    keys = mart.star_keys(owners, *dimensions)
    return cut_lineage(keys)  # dimensions are stored tables when facts are loaded


STAR_SQL = """
    SELECT c_custkey AS owner_id,
           ROW_NUMBER() OVER (ORDER BY c_custkey) AS dim_fund_key,
           DENSE_RANK() OVER (ORDER BY c_mktsegment, CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END)
             AS category_id,
           dim_manager_key, dim_custodian_key
    FROM customer
    JOIN (SELECT n_nationkey, n_regionkey, ROW_NUMBER() OVER (ORDER BY n_nationkey)
                 AS dim_manager_key FROM nation) ON c_nationkey = n_nationkey
    JOIN (SELECT r_regionkey, ROW_NUMBER() OVER (ORDER BY r_regionkey) AS dim_custodian_key
          FROM region) ON n_regionkey = r_regionkey
"""
STAR_COLUMNS = ["dim_fund_key", "dim_manager_key", "category_id", "dim_custodian_key"]


@query(
    f"""
    SELECT CAST(STRFTIME(record_date, '%Y%m%d') AS INTEGER) AS date_id, fund_id,
           {", ".join(STAR_COLUMNS)}, ROUND(nav_value, 2) AS nav_value,
           ROUND(daily_return, 6) AS daily_return
    FROM ({RETURN_SQL}) JOIN ({STAR_SQL}) ON fund_id = owner_id
    """
)
def fact_daily(t):
    facts = mart.fact_rows(daily_returns(t), star_keys(t), "fund_id", "record_date")
    measures = [rounded("nav_value", 2), rounded("daily_return")]
    return facts.select("date_id", "fund_id", *STAR_COLUMNS, *measures)


@query(
    f"""
    SELECT CAST(STRFTIME(record_date, '%Y%m%d') AS INTEGER) AS date_id, fund_id,
           {", ".join(STAR_COLUMNS)}, aum_value, CAST(total_units AS BIGINT) AS total_units
    FROM ({MONTHLY_SQL}) JOIN ({STAR_SQL}) ON fund_id = owner_id
    """
)
def fact_monthly(t):
    """A first load up to 1998, then a load of all months, of which only the
    absent ones are added."""
    columns = ["date_id", "fund_id", *STAR_COLUMNS, "aum_value", "total_units"]
    facts = mart.fact_rows(monthly_amounts(t), star_keys(t), "fund_id", "record_date")
    facts = facts.select(*columns)
    loaded = facts.filter("date_id < 19980101")
    return insert_if_absent(loaded, facts, ["date_id", "fund_id"])


@query(
    """
    SELECT CAST(STRFTIME(record_date, '%Y%m%d') AS INTEGER) AS date_id,
           c_nationkey AS manager_id, dim_manager_key, CAST(aum_value AS DOUBLE) AS aum_value,
           CAST(total_units AS BIGINT) AS total_units
    FROM (SELECT c_nationkey, DATE_TRUNC('month', o_orderdate) AS record_date,
                 SUM(CAST(ROUND(o_totalprice, 2) AS DECIMAL(18, 2))) AS aum_value,
                 COUNT(*) AS total_units
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
    JOIN (SELECT n_nationkey, ROW_NUMBER() OVER (ORDER BY n_nationkey) AS dim_manager_key
          FROM nation) ON c_nationkey = n_nationkey
    """
)
def fact_owner_monthly(t):
    """Orders are added up per customer and month before they meet the nation."""
    month = F.trunc(day("o_orderdate"), "month").alias("record_date")
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), month).agg(
        F.sum(cents("o_totalprice")).alias("amount"), F.count("*").alias("n")
    )
    owners = t.customer.select("c_custkey", F.col("c_nationkey").alias("manager_id"))
    series = (
        per_customer.join(owners, "c_custkey")
        .groupBy("manager_id", "record_date")
        .agg(F.sum("amount").alias("aum_value"), F.sum("n").alias("total_units"))
    )
    managers = t.nation.select(F.col("n_nationkey").alias("manager_id"), "n_name")
    versions = _versions(t, managers, "manager_id", ["n_name"], "dim_manager_key")
    keys = versions.filter("is_current").select("manager_id", "dim_manager_key")
    facts = mart.fact_rows(series, keys, "manager_id", "record_date")
    value = F.col("aum_value").cast("double").alias("aum_value")
    return facts.select("date_id", "manager_id", "dim_manager_key", value, "total_units")


@query(
    f"""
    SELECT CAST(STRFTIME(record_date, '%Y%m%d') AS INTEGER) AS date_id,
           CAST(fund_id AS INTEGER) AS fund_id, CAST(c_nationkey AS INTEGER) AS manager_id, aum_value,
           CAST(total_units AS DOUBLE) AS total_units
    FROM ({MONTHLY_SQL}) JOIN customer ON fund_id = c_custkey
    """
)
def fact_late_dimension(t):
    """The published star schema is loaded twice.  The managers of one region land
    with the second load only, which has no new amounts; their facts come then."""
    root = f"{shared_folder(t.spark)}/{uuid4().hex}"
    nations = t.nation.select(
        F.col("n_nationkey").alias("manager_id"), F.col("n_name").alias("name"), "n_regionkey"
    )
    funds = t.customer.select(
        F.col("c_custkey").alias("fund_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("manager_id"),
        F.lit(1).alias("bank_id"),
        F.col("c_mktsegment").alias("conservative_label"),
        F.lit(1).alias("fund_type"),
    )
    bank = t.region.filter("r_regionkey = 1").select(
        F.col("r_regionkey").alias("bank_id"), F.col("r_name").alias("name")
    )

    def load(batch: str, managers, first: bool) -> Published:
        published = Published(t.spark, root)

        def put(name: str, rows) -> None:
            published.replace(name, conform(rows, CONTRACTS[name]), batch)

        put("investment_manager", managers)
        if first:
            put("mutual_fund", funds)
            put("custodian_bank", bank)
            amounts = conform(monthly_amounts(t), CONTRACTS["aum_record"])
            published.append("aum_record", amounts, batch)
        mart.load_mart(published, batch, LOAD_DAY)
        published.publish(batch)
        return published

    load("first", nations.filter("n_regionkey <> 2"), True)
    published = load("second", nations, False)
    managers = published.read("dim_manager").select("dim_manager_key", "manager_id")
    facts = published.read("fact_aum_monthly").join(managers, "dim_manager_key")
    units = F.col("total_units").cast("double").alias("total_units")
    return facts.select("date_id", "fund_id", "manager_id", "aum_value", units)


@query(
    f"""
    SELECT CAST(STRFTIME(record_date, '%Y%m%d') AS INTEGER) AS date_id,
           CAST(fund_id AS INTEGER) AS manager_id, CAST(aum_value * 100 AS BIGINT) AS cents,
           'transform' AS first_run, 'mart' AS second_run
    FROM ({MONTHLY_SQL}) JOIN customer ON fund_id = c_custkey
    """
)
def resumed_run(t):
    """A run stops after its load.  The next call with the same batch finds the noted
    stages and loads the star from what the first has written."""
    root = f"{shared_folder(t.spark)}/{uuid4().hex}"
    amounts = monthly_amounts(t).select(
        F.col("fund_id").alias("manager_id"), "record_date", "aum_value", "total_units"
    )
    managers = t.customer.select(F.col("c_custkey").alias("manager_id"), F.col("c_name").alias("name"))
    ran = []

    def run(stop: bool) -> None:
        published = Published(t.spark, f"{root}/published")
        clean = Clean(t.spark, f"{root}/clean")

        def transform() -> None:
            clean.save("manager_aum_record", amounts)
            code = F.col("manager_id").cast("string").alias("ojk_code")
            active = F.lit(True).alias("is_active")
            clean.save("investment_manager", managers.select("manager_id", "name", code, active))

        stages = {
            "transform": transform,
            "load": lambda: load(
                published, clean, ["investment_manager", "manager_aum_record"], "b", datetime(2024, 2, 1)
            ),
            "mart": lambda: mart.load_mart(published, "b", LOAD_DAY),
        }
        if stop:
            del stages["mart"]
        ran.append(run_stages(published, "b", stages))
        if not stop:
            published.publish("b")

    run(stop=True)
    run(stop=False)
    published = Published(t.spark, f"{root}/published")
    owners = published.read("dim_manager").select("dim_manager_key", F.col("manager_id").alias("owner"))
    facts = published.read("fact_manager_aum_monthly").join(owners, "dim_manager_key")
    return facts.select(
        "date_id",
        F.col("owner").alias("manager_id"),
        (F.col("aum_value") * 100).cast("bigint").alias("cents"),
        F.lit(ran[0][0]).alias("first_run"),
        F.lit(",".join(ran[1])).alias("second_run"),
    )
