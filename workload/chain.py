"""The whole chain: landed documents of every source to all tables."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import functions as F

from dimflow.plans.refresh import refresh
from dimflow.session import run_together, shared_folder
from dimflow.sources.published import table_counts
from workload.shredding import text_day
from workload.tables import Tables, query

RATING = "ProviderRating"


def documents_of(t: Tables) -> dict:
    """Documents of all sources as file key and body.  Nations are managers, regions
    banks, suppliers sell, customers are funds and orders their prices."""
    custkey, nation = F.col("c_custkey"), F.col("c_nationkey")

    def listed(*fields):
        return F.to_json(F.array(F.struct(*fields)))

    def point(value):
        return F.struct(text_day("o_orderdate").alias("Date"), value.cast("double").alias("Value"))

    person = F.array(F.struct(F.col("n_name").alias("Name"), F.lit("CEO").alias("Title")))
    share = F.array(F.struct(F.col("n_name").alias("Name"), F.lit("Rp 1.000").alias("Share")))
    managers = listed(
        F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Name"),
        F.concat(F.lit("M"), "n_nationkey").alias("OjkCode"), person.alias("Personnel"), share.alias("Share"),
    )
    amounts = listed(
        F.col("n_nationkey").alias("fkFundManager"), F.lit("2026-01-01T00:00:00").alias("Date"),
        (F.col("n_nationkey") + 1.5).alias("Aum"),
    )
    banks = listed(
        F.col("r_regionkey").alias("Id"), F.col("r_name").alias("Name"),
        F.concat(F.lit("B"), "r_regionkey").alias("OjkCode"),
    )
    sales = listed(
        F.col("s_suppkey").alias("Id"), F.col("s_name").alias("Name"),
        F.concat(F.lit("A"), "s_suppkey").alias("AperdId"),
    )
    index = listed(
        custkey.alias("Id"), F.col("c_name").alias("Name"), nation.alias("InvestmentManagerId"),
        (nation % 5).alias("CustodianBankId"), F.concat(F.lit("I"), custkey).alias("IsinCode"),
        (nation % 3 + 1).alias("Type"), F.lit("01-02-2020").alias("IpoDate"),
    )
    products = listed(F.struct(custkey.alias("Id"), nation.alias("FkClassFundId")).alias("Fund"))
    link = F.struct(
        custkey.alias("fkFundId"),
        (custkey % 7 + 1).alias("fkFundSalesCompanyId"),
        F.lit(1.5).alias("CommissionFee"),
    )
    links = listed(F.struct(F.array(link).alias("FundSalesCompanyFunds")).alias("FundSalesCompany"))
    orders = t.orders.filter("o_custkey <> 0")
    of_day = orders.groupBy("o_custkey", "o_orderdate").agg(F.max("o_totalprice").alias("price"))
    points = F.sort_array(F.collect_list(point(F.col("price"))))
    series = of_day.groupBy("o_custkey").agg(points.alias("points"))
    metric = F.array(F.struct(F.lit(1).alias("Period"), F.lit(0.5).alias("Return")))
    rank = F.array(F.struct(F.lit(1).alias("Period"), F.lit(2).alias("RiskRank")))
    fifth = F.col("o_custkey") % 5
    bench = F.array(
        F.struct(
            (fifth + 1).alias("Id"),
            F.concat(F.lit("X"), fifth).alias("Name"),
            F.slice("points", 1, 1).alias("Data"),
        )
    )
    snapshot = F.struct(
        F.col("points").alias("NetAssetValues"), F.slice("points", 1, 1).alias("AssetUnderManagements"),
        metric.alias("Performances"), rank.alias("Rankings"), bench.alias("Benchmarks"),
    )

    def line(kind, category, code):
        stock = F.struct(code.alias("Code"), code.alias("Name"))
        return F.struct(
            F.lit(kind).alias("Type"), category.cast("int").alias("SpesificType"),
            F.concat(F.lit("c"), category).alias("Name"),
            F.lit(40.0).alias("Value"), F.lit(1).alias("fkStockId"), stock.alias("Stock"),
        )

    none = F.lit(None).cast("string")
    assets = F.array(line(0, nation % 4, none), line(1, F.lit(None), F.concat(F.lit("S"), nation % 6)))
    portfolio = listed(F.lit("2026-01-31T00:00:00").alias("DateBased"), assets.alias("Assets"))
    quarter = listed(F.lit("2025-01-01").alias("Date"), F.lit(0.25).alias("Value"))
    year = F.concat_ws("_", custkey, F.lit("2025"))
    return {
        "managers": t.nation.select(F.col("n_nationkey").alias("key"), managers.alias("body")),
        "banks": t.region.select(F.col("r_regionkey").alias("key"), banks.alias("body")),
        "sales": t.supplier.select(F.col("s_suppkey").alias("key"), sales.alias("body")),
        "fund_index": t.customer.select(custkey.alias("key"), index.alias("body")),
        "manager_aum": t.nation.select(F.col("n_nationkey").alias("key"), amounts.alias("body")),
        "products": t.customer.select(custkey.alias("key"), products.alias("body")),
        "snapshot": series.select(F.col("o_custkey").alias("key"), F.to_json(snapshot).alias("body")),
        "portfolio": t.customer.select(custkey.alias("key"), portfolio.alias("body")),
        "quarterly": t.customer.select(year.alias("key"), quarter.alias("body")),
        "sales_companies": t.customer.select(custkey.alias("key"), links.alias("body")),
    }


@query(
    """
    WITH funds AS (SELECT c_custkey AS f, c_nationkey AS n FROM customer WHERE c_custkey <> 0),
    days AS (SELECT DISTINCT o_custkey AS f, o_orderdate AS d FROM orders WHERE o_custkey <> 0),
    firsts AS (SELECT f, MIN(d) AS d FROM days GROUP BY f)
    SELECT table_name, CAST(n_rows AS BIGINT) AS n_rows FROM (
        SELECT 'investment_manager' AS table_name, COUNT(*) AS n_rows FROM nation
        UNION ALL SELECT 'manager_personnel', COUNT(*) FROM nation
        UNION ALL SELECT 'manager_shareholder', COUNT(*) FROM nation
        UNION ALL SELECT 'manager_aum_record', COUNT(*) FROM nation
        UNION ALL SELECT 'custodian_bank', COUNT(*) FROM region
        UNION ALL SELECT 'sales_company', COUNT(*) FROM supplier
        UNION ALL SELECT 'mutual_fund', COUNT(*) FROM funds
        UNION ALL SELECT 'fund_class', COUNT(DISTINCT n) FROM funds WHERE n <> 0
        UNION ALL SELECT 'nav_record', COUNT(*) FROM days
        UNION ALL SELECT 'aum_record', COUNT(*) FROM firsts
        UNION ALL SELECT 'fund_performance', COUNT(*) FROM firsts
        UNION ALL SELECT 'fund_ranking', COUNT(*) FROM firsts
        UNION ALL SELECT 'benchmark', COUNT(DISTINCT f % 5) FROM firsts
        UNION ALL SELECT 'benchmark_data_point', COUNT(DISTINCT (f % 5, d)) FROM firsts
        UNION ALL SELECT 'fund_benchmark', COUNT(*) FROM firsts
        UNION ALL SELECT 'portfolio_snapshot', COUNT(*) FROM funds
        UNION ALL SELECT 'asset_category', COUNT(DISTINCT n % 4) FROM funds
        UNION ALL SELECT 'security', COUNT(DISTINCT n % 6) FROM funds
        UNION ALL SELECT 'portfolio_allocation', COUNT(*) FROM funds
        UNION ALL SELECT 'portfolio_holding', COUNT(*) FROM funds
        UNION ALL SELECT 'fund_quarterly_return', COUNT(*) FROM funds
        UNION ALL SELECT 'fund_sales_company', COUNT(*) FROM funds
        UNION ALL SELECT 'dim_manager', COUNT(*) FROM nation
        UNION ALL SELECT 'dim_custodian', COUNT(*) FROM region
        UNION ALL SELECT 'dim_fund', COUNT(*) FROM funds
        UNION ALL SELECT 'fact_nav_daily', COUNT(*) FROM days
        UNION ALL SELECT 'fact_aum_monthly', COUNT(*) FROM firsts
        UNION ALL SELECT 'fact_manager_aum_monthly', COUNT(*) FROM nation
        UNION ALL SELECT 'latest_nav', COUNT(*) FROM firsts)
    """
)
def whole_chain(t):
    """All 22 relational tables and the star from one landing of all ten sources."""
    root = f"{shared_folder(t.spark)}/{uuid4().hex}"

    def land(name: str, documents) -> None:
        key = F.col("key").cast("string")
        documents.select(
            F.concat(key, F.lit(".json")).alias("file_name"), key.alias("file_key"), "body"
        ).write.parquet(f"{root}/landed/{name}")

    run_together([lambda n=n, d=d: land(n, d) for n, d in documents_of(t).items()])
    published = refresh(
        t.spark, f"{root}/raw", f"{root}/work", f"{root}/tables", datetime(2026, 7, 1, 8),
        rating_field=RATING, landed=f"{root}/landed",
    )
    logs = ("audit_log", "reject_log", "cell_log", "fact_waiting", "category_moments")
    logs += ("dim_date", "dim_category")
    return table_counts({n: published.read(n) for n in published.folders if n not in logs})
