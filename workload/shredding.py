"""Shredding of JSON documents.

Each row of a driver table is written as one landed document, with the faults
the sources have, then parsed and shredded as a landing folder would be.
"""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimflow.operators import shred
from dimflow.operators.keys import number_rows
from dimflow.plans.load import load
from dimflow.plans.transform import Clean
from dimflow.session import cut_lineage, shared_folder
from dimflow.sources import documents as docs
from dimflow.sources.published import Published
from workload.tables import Tables, day, query

def landed(df: DataFrame, row: list[str], file_key, body) -> DataFrame:
    """Rows as landed documents: file key and JSON text, stored before they are
    read.  A document is many times as wide as its row, so rows are spread first,
    by what identifies a row and not by a file key that many rows may share."""
    spread = df.repartition(*row)
    key = file_key.cast("string")
    return cut_lineage(
        spread.select(
            F.concat(key, F.lit(".json")).alias("file_name"),
            key.alias("file_key"),
            body.alias("body"),
        )
    )


def stored(t: Tables, name: str, df: DataFrame) -> DataFrame:
    """Parsed rows that several tables are made from, written out once."""
    return Clean(t.spark, f"{shared_folder(t.spark)}/{uuid4().hex}").save(name, df)


def text_day(column: str, days: int = 0):
    return F.date_format(F.date_add(day(column), days), "yyyy-MM-dd'T'HH:mm:ss")


def manager_documents(t: Tables) -> DataFrame:
    def person(name, title):
        return F.struct(name.alias("Name"), title.alias("Title"))

    amount = F.format_string("Rp %,d", F.floor("c_acctbal").cast("bigint"))
    staff = F.array(
        person(F.col("c_name"), F.lit("CEO")), person(F.col("c_mktsegment"), F.lit("CFO"))
    )
    share = F.array(F.struct(F.col("c_name").alias("Name"), amount.alias("Share")))
    manager = F.struct(
        F.col("c_custkey").alias("Id"),
        F.col("c_name").alias("Name"),
        F.when(F.col("c_acctbal") >= 0, staff).alias("Personnel"),
        F.when(F.col("c_nationkey") != 0, share).alias("Share"),
    )
    return landed(t.customer, ["c_custkey"], F.col("c_custkey"), F.to_json(F.array(manager)))


@query(
    """
    SELECT CAST(c_custkey AS INTEGER) AS manager_id, c_name AS name, 'CEO' AS detail
    FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT c_custkey, c_mktsegment, 'CFO' FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT c_custkey, c_name, CAST(CAST(FLOOR(c_acctbal) AS BIGINT) AS VARCHAR)
    FROM customer WHERE c_nationkey <> 0
    """
)
def shred_children(t):
    """Two child arrays of one document; a null array has no children."""
    managers = docs.parse_arrays(manager_documents(t), shred.MANAGERS)
    staff = shred.personnel(managers).withColumnRenamed("title", "detail")
    shares = shred.shareholders(managers).select(
        "manager_id",
        F.col("shareholder_name").alias("name"),
        F.col("share_amount").cast("string").alias("detail"),
    )
    return staff.unionByName(shares)


def index_documents(t: Tables) -> DataFrame:
    fund = F.struct(
        F.col("c_custkey").alias("Id"),
        F.concat("c_name", F.when(F.col("c_nationkey") < 12, F.lit(" Kelas A")).otherwise("")).alias(
            "Name"
        ),
        F.col("c_nationkey").alias("InvestmentManagerId"),
        F.lit(1).alias("CustodianBankId"),
        F.when(F.col("c_nationkey") > 5, F.concat(F.lit(" "), "c_mktsegment"))
        .otherwise(F.lit("-"))
        .alias("IsinCode"),
        (F.col("c_nationkey") % 9).alias("Type"),
        (F.col("c_acctbal") < 0).alias("Index"),
        F.lit("18-08-2023").alias("IpoDate"),
    )
    return landed(t.customer, ["c_custkey"], F.col("c_custkey"), F.to_json(F.array(fund)))


def detail_documents(t: Tables) -> DataFrame:
    detail = F.struct(
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("2005-05-25T00:00:00")).alias("IpoDate"),
        F.format_string("Rp %,d", F.floor(F.abs("c_acctbal")).cast("bigint")).alias("MinSubNum"),
        F.col("c_acctbal").alias("MinRedNum"),
        F.concat(F.lit("Maks 0,"), F.col("c_nationkey").cast("string"), F.lit("%")).alias(
            "MaxSubscriptionFee"
        ),
    )
    good = F.to_json(F.struct(detail.alias("Detail")))
    body = (
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("null"))
        .when(F.col("c_mktsegment") == "BUILDING", F.lit('{"_error": "timeout"}'))
        .otherwise(good)
    )
    return landed(t.customer, ["c_custkey"], F.col("c_custkey"), body)


def product_documents(t: Tables) -> DataFrame:
    product = F.struct(
        F.struct(
            F.col("c_custkey").alias("Id"), F.col("c_nationkey").alias("FkClassFundId")
        ).alias("Fund")
    )
    return landed(t.customer, ["c_custkey"], F.col("c_custkey"), F.to_json(F.array(product)))


@query(
    """
    SELECT CAST(c_custkey AS INTEGER) AS fund_id,
           NULLIF(c_nationkey, 0) AS class_group_id, c_name AS base_name,
           CASE WHEN c_nationkey < 12 THEN 'Kelas A' END AS class_name,
           CASE WHEN c_nationkey > 5 THEN c_mktsegment END AS isin_code,
           CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'BUILDING') AND c_nationkey % 2 = 0
                THEN DATE '2005-05-25' ELSE DATE '2023-08-18' END AS ipo_date,
           CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'BUILDING')
                THEN CAST(FLOOR(ABS(c_acctbal)) AS BIGINT) END AS min_subscription,
           CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'BUILDING')
                THEN CAST(TRUNC(c_acctbal) AS BIGINT) END AS min_redemption,
           CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'BUILDING')
                THEN CAST('0.' || c_nationkey AS DOUBLE) END AS sub_fee_max_pct,
           CASE WHEN c_acctbal < 0 THEN 'Indeks'
                ELSE CASE c_nationkey % 9 WHEN 0 THEN 'Campuran' WHEN 1 THEN 'Saham'
                     WHEN 2 THEN 'Pendapatan Tetap' WHEN 3 THEN 'Pasar Uang'
                     WHEN 4 THEN 'Terproteksi' WHEN 7 THEN 'Reksadana Global'
                     ELSE 'Lainnya' END END AS conservative_label
    FROM customer WHERE c_custkey <> 0
    """
)
def shred_parent_detail(t):
    index = shred.real_funds(docs.parse_arrays(index_documents(t), shred.FUND_INDEX))
    snapshots = docs.parse_objects(detail_documents(t), shred.snapshot_shape("ProviderRating"))
    classes = shred.class_map(docs.parse_arrays(product_documents(t), shred.PRODUCTS))
    return shred.funds(index, snapshots, classes).select(
        "fund_id",
        "class_group_id",
        "base_name",
        "class_name",
        "isin_code",
        "ipo_date",
        "min_subscription",
        "min_redemption",
        "sub_fee_max_pct",
        "conservative_label",
    )


def series_documents(t: Tables) -> DataFrame:
    """One order is one fund with three prices, three values and repeated units."""

    def point(date, value):
        return F.struct(date.alias("Date"), value.cast("double").alias("Value"))

    price, pending = F.col("o_totalprice"), F.col("o_orderstatus") == "P"
    first, second, third = (text_day("o_orderdate", d) for d in (0, 31, 62))
    prices = F.array(
        point(first, price), point(third, F.when(~pending, F.lit(0))), point(second, price / 2)
    )
    values = F.array(
        point(first, price),
        point(second, F.when(~pending, price + 1)),
        point(third, -price),
        point(F.lit(None).cast("string"), price),
    )
    units = F.array(
        point(first, F.col("o_custkey")),
        point(first, F.col("o_custkey") + 1),
        point(third, F.lit(5)),
    )
    metrics = F.array(
        F.struct(F.lit(1).alias("Period"), (price / 1000).alias("Return"), F.lit(0.5).alias("Beta")),
        F.struct(
            F.when(~pending, F.lit(2)).alias("Period"),
            F.lit(0.25).alias("Return"),
            F.lit(None).cast("double").alias("Beta"),
        ),
    )
    ranks = F.array(
        F.struct(
            F.lit(3).alias("Period"),
            F.when(pending, F.lit(7)).alias("Category"),
            F.col("o_custkey").cast("int").alias("RiskRank"),
            F.lit(4.5).alias("ProviderRating"),
        )
    )
    digit = F.left("o_orderpriority", F.lit(1)).cast("int")
    benchmark = F.struct(
        digit.alias("Id"),
        F.col("o_orderpriority").alias("Name"),
        F.array(point(first, F.when(~pending, price)), point(first, price * 2)).alias("Data"),
    )
    other = F.struct(
        F.lit(9).alias("Id"),
        F.col("o_orderstatus").alias("Name"),
        F.when(pending, F.array(point(second, price))).alias("Data"),
    )
    snapshot = F.struct(
        F.when(F.col("o_orderstatus") != "F", prices).alias("NetAssetValues"),
        values.alias("AssetUnderManagements"),
        units.alias("TotalUnits"),
        metrics.alias("Performances"),
        ranks.alias("Rankings"),
        F.when(pending, F.struct(digit.alias("Id"))).alias("Benchmark"),
        F.array(benchmark, other, benchmark).alias("Benchmarks"),
    )
    return landed(t.orders, ["o_orderkey"], F.col("o_orderkey"), F.to_json(snapshot))


def snapshots_of(t: Tables) -> DataFrame:
    return docs.parse_objects(series_documents(t), shred.snapshot_shape("ProviderRating"))


@query(
    """
    SELECT * FROM (
        SELECT CAST(o_orderkey AS INTEGER) AS fund_id, d AS record_date, v AS nav_value,
               CASE WHEN v IS NULL THEN 'no value' WHEN v <= 0 THEN 'value not positive' END
                 AS reject_reason
        FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS v, o_orderstatus
              FROM orders
              UNION ALL
              SELECT o_orderkey, CAST(o_orderdate AS DATE) + 62,
                     CASE WHEN o_orderstatus <> 'P' THEN 0 END, o_orderstatus FROM orders
              UNION ALL
              SELECT o_orderkey, CAST(o_orderdate AS DATE) + 31, o_totalprice / 2, o_orderstatus
              FROM orders)
        WHERE o_orderstatus <> 'F' AND o_orderkey <> 0)
    """
)
def shred_nav_series(t):
    return shred.nav(snapshots_of(t)).select("fund_id", "record_date", "nav_value", "reject_reason")


@query(
    """
    SELECT CAST(o_orderkey AS INTEGER) AS fund_id, d AS record_date, LAST_DAY(d) AS published_date,
           CAST(TRUNC(v) AS BIGINT) AS aum_value,
           CASE WHEN d = CAST(o_orderdate AS DATE) THEN CAST(o_custkey + 1 AS DOUBLE)
                WHEN d = CAST(o_orderdate AS DATE) + 62 THEN 5.0 END AS total_units,
           CASE WHEN v IS NULL THEN 'no value' WHEN v < 0 THEN 'negative value'
                WHEN d IS NULL THEN 'no date' END AS reject_reason
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS d, o_totalprice AS v FROM orders
          UNION ALL
          SELECT *, CAST(o_orderdate AS DATE) + 31,
                 CASE WHEN o_orderstatus <> 'P' THEN o_totalprice + 1 END FROM orders
          UNION ALL
          SELECT *, CAST(o_orderdate AS DATE) + 62, -o_totalprice FROM orders
          UNION ALL
          SELECT *, NULL, o_totalprice FROM orders)
    WHERE o_orderkey <> 0
    """
)
def shred_two_arrays(t):
    """Values with the last units of the same date, from two arrays."""
    parsed = stored(t, "parsed_snapshot", snapshots_of(t))
    return shred.aum(parsed).select(
        "fund_id", "record_date", "published_date", "aum_value", "total_units", "reject_reason"
    )


@query(
    """
    SELECT CAST(o_orderkey AS INTEGER) AS fund_id, period_code,
           CAST(o_orderdate AS DATE) + 62 AS as_of_date, return_pct, beta
    FROM (SELECT *, 1 AS period_code, o_totalprice / 1000 AS return_pct, 0.5 AS beta FROM orders
          UNION ALL
          SELECT *, 2, 0.25, NULL FROM orders WHERE o_orderstatus <> 'P')
    WHERE o_orderkey <> 0 AND o_orderstatus <> 'F'
    """
)
def shred_asof_metrics(t):
    """The as-of date is the latest price date, of rejected prices too."""
    return shred.performance(snapshots_of(t)).select(
        "fund_id", "period_code", "as_of_date", "return_pct", "beta"
    )


@query(
    """
    SELECT CAST(o_orderkey AS INTEGER) AS fund_id, 3 AS period_code,
           CASE WHEN o_orderstatus = 'P' THEN 7 ELSE 0 END AS category_code,
           CAST(o_orderdate AS DATE) + 62 AS as_of_date, CAST(o_custkey AS INTEGER) AS risk_rank,
           4.5 AS provider_rating
    FROM orders WHERE o_orderkey <> 0 AND o_orderstatus <> 'F'
    """
)
def shred_rankings(t):
    ranks = shred.ranking(snapshots_of(t), "ProviderRating").select(
        "fund_id", "period_code", "category_code", "as_of_date", "risk_rank", "provider_rating"
    )
    return ranks


BENCHMARK_POINTS_SQL = """
    SELECT CAST(LEFT(o_orderpriority, 1) AS INTEGER) AS benchmark_id, o_orderkey || '.json' AS f,
           0 AS pos, CAST(o_orderdate AS DATE) AS record_date,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice ELSE o_totalprice * 2 END AS value
    FROM orders WHERE o_orderkey <> 0
    UNION ALL
    SELECT 9, o_orderkey || '.json', 1, CAST(o_orderdate AS DATE) + 31, o_totalprice
    FROM orders WHERE o_orderkey <> 0 AND o_orderstatus = 'P'
"""


@query(
    f"""
    SELECT benchmark_id, record_date, value FROM ({BENCHMARK_POINTS_SQL})
    QUALIFY ROW_NUMBER() OVER (PARTITION BY benchmark_id, record_date ORDER BY f, pos) = 1
    """
)
def shred_nested_arrays(t):
    """Points of an array in an array: first file, position and value win."""
    return shred.benchmark_points(shred.fund_benchmarks(snapshots_of(t)))


@query(
    """
    SELECT DISTINCT CAST(LEFT(o_orderpriority, 1) AS INTEGER) AS benchmark_id,
           o_orderpriority AS name FROM orders WHERE o_orderkey <> 0
    UNION ALL
    SELECT 9, ARG_MAX(o_orderstatus, o_orderkey || '.json') FROM orders WHERE o_orderkey <> 0
    """
)
def shred_benchmark_names(t):
    return shred.benchmarks(shred.fund_benchmarks(snapshots_of(t)))


@query(
    """
    SELECT CAST(o_orderkey AS INTEGER) AS fund_id,
           CAST(LEFT(o_orderpriority, 1) AS INTEGER) AS benchmark_id,
           o_orderstatus = 'P' AS is_official FROM orders WHERE o_orderkey <> 0
    UNION ALL
    SELECT o_orderkey, 9, FALSE FROM orders WHERE o_orderkey <> 0
    """
)
def shred_official_links(t):
    return shred.benchmark_links(shred.fund_benchmarks(snapshots_of(t)))


def portfolio_documents(t: Tables) -> DataFrame:
    """One order is one portfolio of two class lines and three instruments."""

    def line(kind, category, name, value, stock, code):
        return F.struct(
            F.lit(kind).alias("Type"),
            category.cast("int").alias("SpesificType"),
            name.alias("Name"),
            value.cast("double").alias("Value"),
            F.lit(stock).cast("int").alias("fkStockId"),
            F.struct(code.alias("Code"), name.alias("Name")).alias("Stock"),
        )

    none, digit = F.lit(None).cast("string"), F.left("o_orderpriority", F.lit(1))
    whole = F.floor(F.col("o_totalprice") / 4900)
    body = F.struct(
        F.when(F.col("o_orderstatus") != "P", text_day("o_orderdate")).alias("DateBased"),
        F.array(
            line(0, digit, F.col("o_orderpriority"), whole, None, none),
            line(0, digit, F.lit("again"), F.lit(1), None, none),
            line(1, F.lit(None), F.lit("x"), whole / 2, 3, F.col("o_orderpriority")),
            line(1, F.lit(None), F.lit("y"), F.lit(2), 4, F.col("o_orderpriority")),
            line(2, F.lit(None), F.concat(F.lit("Bond "), "o_orderstatus"), F.lit(1.5), 5, none),
            line(1, F.lit(None), F.lit("no code"), F.lit(1), 6, none),
        ).alias("Assets"),
    )
    return landed(t.orders, ["o_orderkey"], F.col("o_custkey"), F.to_json(F.array(body)))


def portfolio_lines(t: Tables) -> DataFrame:
    valid = t.customer.select(F.col("c_custkey").alias("fund_id")).filter("fund_id <> 0")
    nested = docs.parse_arrays(portfolio_documents(t), shred.PORTFOLIO)
    return shred.portfolio_lines(shred.portfolio_snapshots(nested, valid))


PORTFOLIO_SQL = """
    SELECT o_custkey AS fund_id, CAST(o_orderdate AS DATE) AS date_based, o_orderpriority,
           o_orderstatus, FLOOR(o_totalprice / 4900) AS whole
    FROM orders WHERE o_custkey <> 0 AND o_orderstatus <> 'P'
"""


@query(
    f"""
    WITH lines AS (
        SELECT fund_id, date_based, o_orderpriority AS code, whole / 2 AS v FROM ({PORTFOLIO_SQL})
        UNION ALL
        SELECT fund_id, date_based, o_orderpriority, 2 FROM ({PORTFOLIO_SQL})
        UNION ALL
        SELECT fund_id, date_based, 'Bond ' || o_orderstatus, 1.5 FROM ({PORTFOLIO_SQL})),
    codes AS (
        SELECT code, ROW_NUMBER() OVER (ORDER BY code) AS security_id
        FROM (SELECT DISTINCT code FROM lines))
    SELECT CAST(fund_id AS INTEGER) AS fund_id, date_based, security_id, SUM(v) AS value_pct
    FROM lines JOIN codes USING (code) WHERE v BETWEEN 0 AND 100 GROUP BY 1, 2, 3
    """
)
def shred_typed_array(t):
    """Instruments of a mixed array, numbered in code order.  Few codes fill the
    table: lines are added up per portfolio and code before the join."""
    lines = stored(t, "portfolio_line", portfolio_lines(t))
    security = number_rows(shred.securities(lines), ["code"], "security_id")
    held = shred.holdings(lines).join(security.select("code", "security_id"), "code")
    value = F.col("value_pct").cast("double").alias("value_pct")
    return held.select("fund_id", "date_based", "security_id", value)


@query(
    f"""
    SELECT CAST(fund_id AS INTEGER) AS fund_id, date_based,
           CAST(LEFT(o_orderpriority, 1) AS INTEGER) AS category_id, SUM(v) AS value_pct
    FROM (SELECT *, whole AS v FROM ({PORTFOLIO_SQL})
          UNION ALL SELECT *, 1 FROM ({PORTFOLIO_SQL}))
    WHERE v BETWEEN 0 AND 100 GROUP BY 1, 2, 3
    """
)
def shred_allocations(t):
    value = F.col("value_pct").cast("double").alias("value_pct")
    return shred.allocations(portfolio_lines(t)).withColumn("value_pct", value)


@query(
    """
    SELECT CAST(o_custkey AS INTEGER) AS fund_id, CAST(o_orderdate AS DATE) AS quarter_start,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS return_pct,
           CASE WHEN o_orderstatus = 'P' THEN 'quarter not run yet' END AS reject_reason
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0
    """
)
def shred_keyed_periods(t):
    """The fund is the first part of the file name, ``fund_year``."""
    quarter = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("Value"),
    )
    # A null field must be written, as the source does.
    body = F.to_json(F.array(quarter), {"ignoreNullFields": "false"})
    key = F.concat_ws("_", F.col("o_custkey"), F.year("o_orderdate"))
    found = docs.parse_arrays(landed(t.orders, ["o_orderkey"], key, body), shred.QUARTERLY)
    valid = t.customer.filter("c_acctbal >= 0").select(
        F.col("c_custkey").cast("int").alias("fund_id")
    )
    return shred.quarterly_returns(found, valid).select(
        "fund_id", "quarter_start", "return_pct", "reject_reason"
    )


@query(
    """
    SELECT DISTINCT CAST(o_custkey AS INTEGER) AS entity_id, YEAR(o_orderdate)::INTEGER AS period
    FROM orders
    """
)
def composite_file_keys(t):
    key = F.concat_ws("_", F.col("o_custkey"), F.year("o_orderdate"))
    entity, period = docs.composite_key(F.col("k"))
    keys = t.orders.select(key.alias("k")).distinct()
    return keys.select(entity.alias("entity_id"), period.alias("period"))


@query(
    """
    SELECT CAST(l_partkey AS INTEGER) AS fund_id, CAST(l_suppkey AS INTEGER) AS company_id,
           ABS(l_tax) AS commission_fee
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 40
    QUALIFY ROW_NUMBER() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY
        l_orderkey || '_' || l_linenumber || '_' || CAST(ROUND(l_extendedprice * 100) AS BIGINT)
        || '.json' DESC) = 1
    """
)
def shred_sales_links(t):
    """Links nested two levels deep; the last fee per fund and company wins."""
    link = F.struct(
        F.col("l_partkey").alias("fkFundId"),
        F.col("l_suppkey").alias("fkFundSalesCompanyId"),
        F.abs("l_tax").alias("CommissionFee"),
    )
    nested = F.struct(F.struct(F.array(link).alias("FundSalesCompanyFunds")).alias("FundSalesCompany"))
    price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    key = F.concat_ws("_", "l_orderkey", "l_linenumber", price)
    row = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    documents = landed(t.lineitem, row, key, F.to_json(F.array(nested)))
    found = docs.parse_arrays(documents, shred.FUND_SALES)
    valid = t.part.filter("p_size <= 40").select(F.col("p_partkey").cast("int").alias("fund_id"))
    return shred.fund_sales(found, valid)


@query(
    """
    SELECT CAST(s_suppkey AS INTEGER) AS bank_id, s_name AS name,
           CASE WHEN s_acctbal >= 0 THEN 'N' || s_nationkey END AS ojk_code,
           CASE WHEN s_nationkey = 0 THEN FALSE ELSE s_nationkey <> 1 END AS is_active,
           DATE '2020-09-10' AS data_last_update
    FROM supplier
    """
)
def master_projection(t):
    """The active flag is true when absent and false when it is null."""
    nation = F.col("s_nationkey")
    flag = F.when(nation == 0, "null").when(nation == 1, "false").otherwise("true")
    code = F.when(F.col("s_acctbal") >= 0, F.concat(F.lit(" N"), nation)).otherwise(F.lit("-"))
    active = F.when(nation > 12, F.lit("")).otherwise(F.concat(F.lit(', "IsActive": '), flag))
    body = F.format_string(
        '[{"Id": %d, "Name": "%s", "OjkCode": "%s", "DataLastUpdate": "10-09-2020"%s}]',
        "s_suppkey",
        "s_name",
        code,
        active,
    )
    found = docs.parse_arrays(landed(t.supplier, ["s_suppkey"], F.col("s_suppkey"), body), shred.BANKS)
    return shred.banks(found).select("bank_id", "name", "ojk_code", "is_active", "data_last_update")


@query(
    """
    SELECT CAST(CASE WHEN c_nationkey = 0 THEN c_custkey ELSE c_nationkey END AS INTEGER)
             AS manager_id, DATE '2026-01-01' AS record_date, c_acctbal AS aum_value,
           CASE WHEN c_acctbal < 0 THEN 'negative value' END AS reject_reason
    FROM customer
    """
)
def shred_manager_series(t):
    """The manager is named in the row, or else by the file."""
    row = F.struct(
        F.col("c_nationkey").alias("fkFundManager"),
        F.lit("2026-01-01T00:00:00").alias("Date"),
        F.col("c_acctbal").alias("Aum"),
    )
    body = F.to_json(F.array(row))
    found = docs.parse_arrays(landed(t.customer, ["c_custkey"], F.col("c_custkey"), body), shred.MANAGER_AUM)
    return shred.manager_aum(found).select(
        "manager_id", "record_date", "aum_value", "reject_reason"
    )


@query(
    f"""
    SELECT line_type, reason, CAST(COUNT(*) AS BIGINT) AS n_lines FROM (
        SELECT 0 AS line_type, CASE WHEN whole NOT BETWEEN 0 AND 100 THEN 'outside 0..100' END AS reason
        FROM ({PORTFOLIO_SQL})
        UNION ALL SELECT 1, CASE WHEN whole / 2 NOT BETWEEN 0 AND 100 THEN 'outside 0..100' END
        FROM ({PORTFOLIO_SQL})
        UNION ALL SELECT 1, 'no category or code' FROM ({PORTFOLIO_SQL}))
    WHERE reason IS NOT NULL GROUP BY 1, 2
    """
)
def dropped_portfolio_lines(t):
    """Lines whose share cannot be one, and an instrument without a code."""
    return shred.dropped_lines(portfolio_lines(t))


@query(
    """
    SELECT CAST(LEFT(o_orderpriority, 1) AS SMALLINT) AS category_id, name FROM (
        SELECT o_orderpriority, ARG_MIN(o_orderpriority, o_custkey) AS name FROM orders
        WHERE o_custkey <> 0 AND o_orderstatus <> 'P' GROUP BY 1)
    """
)
def shred_categories(t):
    """Every class by its first mention, which comes before the one named "again"."""
    kinds = shred.categories(portfolio_lines(t))
    return kinds.select(F.col("category_id").cast("smallint").alias("category_id"), "name")


@query(
    """
    SELECT CAST(s_suppkey AS INTEGER) AS company_id, s_name AS name, 'A' || s_suppkey AS aperd_id,
           CASE WHEN s_nationkey % 2 = 0 THEN 'N-' || s_nationkey END AS npwp,
           CASE WHEN s_acctbal >= 0 THEN s_name END AS contact_person
    FROM supplier
    """
)
def shred_sales_companies(t):
    """Blank and dash texts are null, and texts are trimmed."""
    number = F.col("s_nationkey")
    company = F.struct(
        F.col("s_suppkey").alias("Id"),
        F.col("s_name").alias("Name"),
        F.concat(F.lit("A"), "s_suppkey").alias("AperdId"),
        F.when(number % 2 == 0, F.concat(F.lit(" N-"), number)).otherwise(F.lit(" - ")).alias("Npwp"),
        F.when(F.col("s_acctbal") >= 0, F.concat("s_name", F.lit("\n"))).otherwise(F.lit("")).alias(
            "ContactPerson"
        ),
    )
    body = F.to_json(F.array(company))
    found = docs.parse_arrays(landed(t.supplier, ["s_suppkey"], F.col("s_suppkey"), body), shred.SALES_COMPANIES)
    return shred.sales_companies(found).select("company_id", "name", "aperd_id", "npwp", "contact_person")


METRICS = list(shred.METRIC_FIELDS)


@query(
    f"""
    SELECT CAST(o_orderkey AS INTEGER) AS fund_id, CAST(o_orderdate AS DATE) AS as_of_date,
           {", ".join(f"(o_custkey + {i}) / 8 AS {name}" for i, name in enumerate(METRICS))}
    FROM orders WHERE o_orderkey <> 0
    """
)
def shred_all_metrics(t):
    """All eleven metrics of a period, by their source names."""
    values = [
        ((F.col("o_custkey") + i) / 8).alias(field) for i, field in enumerate(shred.METRIC_FIELDS.values())
    ]
    point = F.struct(text_day("o_orderdate").alias("Date"), F.lit(1.0).alias("Value"))
    snapshot = F.struct(
        F.array(point).alias("NetAssetValues"),
        F.array(F.struct(F.lit(1).alias("Period"), *values)).alias("Performances"),
    )
    documents = landed(t.orders, ["o_orderkey"], F.col("o_orderkey"), F.to_json(snapshot))
    found = docs.parse_objects(documents, shred.snapshot_shape("ProviderRating"))
    return shred.performance(found).select("fund_id", "as_of_date", *METRICS)


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS record_pk, column_name, raw_value, reason FROM (
        SELECT c_custkey, 'data_last_update' AS column_name, 'soon ' || c_name AS raw_value,
               'no date' AS reason FROM customer WHERE c_nationkey % 5 = 1
        UNION ALL
        SELECT c_custkey, 'capital', c_mktsegment, 'no number' FROM customer WHERE c_nationkey % 3 = 0)
    """
)
def rejected_cells(t):
    """Dates and amounts of a master that cannot be read, loaded twice; each is logged
    once, with its text.  A dash, a blank and an absent value are nothing."""
    nation = F.col("c_nationkey")
    update = (
        F.when(nation % 5 == 0, F.lit("10-09-2020"))
        .when(nation % 5 == 1, F.concat(F.lit("soon "), "c_name"))
        .when(nation % 5 == 2, F.lit(" - "))
        .when(nation % 5 == 3, F.lit("2020-09-10T00:00:00"))
    )
    capital = F.when(nation % 3 == 0, F.col("c_mktsegment")).when(nation % 3 == 1, F.lit("Rp 1.000"))
    manager = F.struct(
        F.col("c_custkey").alias("Id"),
        F.col("c_name").alias("Name"),
        F.concat(F.lit("C"), "c_custkey").alias("OjkCode"),
        update.alias("DataLastUpdate"),
        capital.alias("Capital"),
        F.lit(5).alias("PaidInCapital"),
    )
    documents = landed(t.customer, ["c_custkey"], F.col("c_custkey"), F.to_json(F.array(manager)))
    managers = shred.managers(docs.parse_arrays(documents, shred.MANAGERS))
    root = f"{shared_folder(t.spark)}/{uuid4().hex}"
    for n in (1, 2):
        clean = Clean(t.spark, f"{root}/clean/{n}")
        clean.save("investment_manager", managers)
        published = Published(t.spark, f"{root}/published")
        load(published, clean, ["investment_manager"], f"day{n}", datetime(2024, 2, n))
        published.publish(f"day{n}")
    log = Published(t.spark, f"{root}/published").read("cell_log")
    return log.select("record_pk", "column_name", "raw_value", "reason")
