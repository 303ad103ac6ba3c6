"""Nested documents to flat tables.

Every function takes parsed documents (see :mod:`dimflow.sources.documents`)
and returns DataFrames; a series comes back with ``reject_reason`` so the
caller can take the accepted rows and count the others.  First and last wins
follow the file name and then the position in the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.contracts import METRIC_COLUMNS
from dimflow.functions import dates, labels, text
from dimflow.functions.checks import given
from dimflow.operators.dedup import first_per_key, last_per_key
from dimflow.operators.merge import sum_duplicates
from dimflow.operators.quality import lost_cells, mark_rejects

# Shapes of the source documents.
MANAGERS = (
    "Id int, Name string, OjkCode string, MiPermitNum string, PpePermitNum string, "
    "PeePermitNum string, Description string, Address string, TelephoneNumber string, "
    "FaxNumber string, Email string, WebsiteUrl string, Capital variant, PaidInCapital variant, "
    "IsActive variant, DataLastUpdate string, "
    "Personnel array<struct<Name:string,Title:string>>, "
    "Share array<struct<Name:string,Share:variant>>"
)
BANKS = (
    "Id int, Name string, OjkCode string, Description string, Address string, "
    "TelephoneNumber string, FaxNumber string, Email string, WebsiteUrl string, "
    "NiuBankUmum string, NiuBk string, DateStartSk string, OwnershipStatus string, "
    "ActivityStatus string, IsActive variant, DataLastUpdate string"
)
SALES_COMPANIES = (
    "Id int, Name string, AperdId string, Npwp string, NoSttdSk string, DateSttdSk string, "
    "Address string, TelephoneNumber string, Fax string, Email string, WebsiteUrl string, "
    "ContactPerson string"
)
FUND_INDEX = (
    "Id int, Name string, InvestmentManagerId int, CustodianBankId int, IsinCode string, "
    "BloombergQuote string, Type int, Currency variant, Sharia variant, "
    "ExchangeTradedFund variant, Index variant, Dividend variant, IpoDate string, "
    "LastUpdate string, ConservativeCategory string"
)
PRODUCTS = "Fund struct<Id:int,FkClassFundId:int>"
MANAGER_AUM = "fkFundManager int, Date string, Aum double, TotalUnit double"
POINTS = "array<struct<Date:string,Value:double,ClassTotalValue:double>>"


def snapshot_shape(rating_field: str) -> str:
    """Shape of a fund snapshot; the source names one rating after itself."""
    return (
        "Detail struct<IsActive:variant,IpoDate:string,Description:string,"
        "OfficialBenchmark:string,MinSubNum:variant,MinNextSubNum:variant,MinRedNum:variant,"
        "MinBalanceNum:variant,MaxSubscriptionFee:variant,MaxRedemptionFee:variant,"
        "MaxSwitchingFee:variant,MaxInvestmentManagerFee:variant,MaxCustodianBankFee:variant,"
        "InvestmentBond:variant,InvestmentEquity:variant,InvestmentMoneyMarket:variant>, "
        f"NetAssetValues {POINTS}, AssetUnderManagements {POINTS}, "
        "TotalUnits array<struct<Date:string,Value:double>>, "
        "Performances array<struct<Period:variant,Return:double,StandardDeviation:double,"
        "Beta:double,SharpeRatio:double,ModifiedSharpeRatio:double,TreynorRatio:double,"
        "SortinoRatio:double,TrackingError:double,MaxDrawdown:double,Cagr:double,"
        "JensenAlpha:double>>, "
        "Rankings array<struct<Period:variant,Category:variant,RiskRank:int,RatingRank:int,"
        f"AllRiskRank:int,{rating_field}:double,RiskRating:double,AllRiskRating:double>>, "
        "Benchmark struct<Id:int>, "
        "Benchmarks array<struct<Id:int,Name:string,"
        "Data:array<struct<Date:string,Value:double>>>>"
    )


PORTFOLIO = (
    "DateBased string, DomesticAllocation variant, ForeignAllocation variant, "
    "Assets array<struct<Type:int,SpesificType:int,Name:string,Value:double,fkStockId:int,"
    "Stock:struct<Code:string,Name:string>>>"
)
QUARTERLY = "Date string, Value double"
FUND_SALES = (
    "FundSalesCompany struct<FundSalesCompanyFunds:array<struct<fkFundId:int,"
    "fkFundSalesCompanyId:int,CommissionFee:double>>>"
)

CATEGORY_LINE, STOCK_LINE, BOND_LINE = 0, 1, 2
PERCENT = "decimal(18,8)"  # exact sums, whatever the order of the lines


def _text_columns(fields: dict[str, str]) -> list[Column]:
    return [text.blank_to_null(F.col(source)).alias(out) for source, out in fields.items()]


NO_DATE, NO_NUMBER = "no date", "no number"


def _lost_date(name: str, raw: Column) -> dict[str, tuple[Column, Column, str]]:
    return {name: (raw, dates.parse_date(raw), NO_DATE)}


def _lost_number(name: str, value: Column) -> dict[str, tuple[Column, Column, str]]:
    raw = F.try_variant_get(value, "$", "string")
    return {name: (raw, text.whole_number_value(value), NO_NUMBER)}


def managers(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("Id").alias("manager_id"),
        F.col("Name").alias("name"),
        F.col("OjkCode").alias("ojk_code"),
        F.col("Description").alias("description"),
        F.col("Address").alias("address"),
        *_text_columns(
            {
                "MiPermitNum": "mi_permit_num",
                "PpePermitNum": "ppe_permit_num",
                "PeePermitNum": "pee_permit_num",
                "TelephoneNumber": "telephone",
                "FaxNumber": "fax",
                "Email": "email",
                "WebsiteUrl": "website_url",
            }
        ),
        text.whole_number_value(F.col("Capital")).alias("capital"),
        text.whole_number_value(F.col("PaidInCapital")).alias("paid_in_capital"),
        text.flag_value(F.col("IsActive"), absent=True).alias("is_active"),
        dates.parse_date(F.col("DataLastUpdate")).alias("data_last_update"),
        lost_cells(
            {
                **_lost_date("data_last_update", F.col("DataLastUpdate")),
                **_lost_number("capital", F.col("Capital")),
                **_lost_number("paid_in_capital", F.col("PaidInCapital")),
            }
        ),
    )


def personnel(documents: DataFrame) -> DataFrame:
    staff = documents.select(F.col("Id").alias("manager_id"), F.explode("Personnel").alias("p"))
    return staff.select("manager_id", F.col("p.Name").alias("name"), F.col("p.Title").alias("title"))


def shareholders(documents: DataFrame) -> DataFrame:
    shares = documents.select(F.col("Id").alias("manager_id"), F.explode("Share").alias("s"))
    return shares.select(
        "manager_id",
        F.col("s.Name").alias("shareholder_name"),
        text.whole_number_value(F.col("s.Share")).alias("share_amount"),
    )


def manager_aum(documents: DataFrame) -> DataFrame:
    rows = documents.select(
        text.first_nonzero(F.col("fkFundManager"), F.col("file_key").try_cast("int")).alias(
            "manager_id"
        ),
        dates.parse_date(F.col("Date")).alias("record_date"),
        F.col("Aum").alias("aum_value"),
        F.col("TotalUnit").alias("total_units"),
        "file_name",
        "pos",
    )
    return mark_rejects(
        rows,
        {
            "no date": F.col("record_date").isNull(),
            "no value": F.col("aum_value").isNull(),
            "negative value": F.col("aum_value") < 0,
        },
    )


def banks(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("Id").alias("bank_id"),
        F.col("Name").alias("name"),
        F.col("Description").alias("description"),
        F.col("Address").alias("address"),
        *_text_columns(
            {
                "OjkCode": "ojk_code",
                "TelephoneNumber": "telephone",
                "FaxNumber": "fax",
                "Email": "email",
                "WebsiteUrl": "website_url",
                "NiuBankUmum": "niu_bank_umum",
                "NiuBk": "niu_bk",
                "DateStartSk": "date_start_sk",
                "OwnershipStatus": "ownership_status",
                "ActivityStatus": "activity_status",
            }
        ),
        text.flag_value(F.col("IsActive"), absent=True).alias("is_active"),
        dates.parse_date(F.col("DataLastUpdate")).alias("data_last_update"),
        lost_cells(_lost_date("data_last_update", F.col("DataLastUpdate"))),
    )


def sales_companies(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("Id").alias("company_id"),
        F.col("Name").alias("name"),
        F.col("AperdId").alias("aperd_id"),
        F.col("Address").alias("address"),
        *_text_columns(
            {
                "Npwp": "npwp",
                "NoSttdSk": "no_sttd_sk",
                "DateSttdSk": "date_sttd_sk",
                "TelephoneNumber": "telephone",
                "Fax": "fax",
                "Email": "email",
                "WebsiteUrl": "website_url",
                "ContactPerson": "contact_person",
            }
        ),
    )


def real_funds(index: DataFrame) -> DataFrame:
    """The index without the placeholder id 0, under which market indices are listed."""
    return index.filter("Id <> 0")


def class_map(products: DataFrame) -> DataFrame:
    """Fund to class group; the last mention wins and id 0 is no id."""
    pairs = products.select(
        F.col("Fund.Id").alias("fund_id"),
        F.col("Fund.FkClassFundId").alias("class_group_id"),
        "file_name",
        "pos",
    ).filter("fund_id <> 0 AND class_group_id <> 0")
    return last_per_key(pairs, ["fund_id"], ["file_name", "pos"]).select(
        "fund_id", "class_group_id"
    )


def funds(index: DataFrame, snapshots: DataFrame, classes: DataFrame) -> DataFrame:
    """Fund master from the index, the detail part of the snapshot and the class
    map.  ``pos`` keeps the order of the index; ``source_label`` the label the
    source gives."""
    detail = snapshots.select(F.col("file_key").try_cast("int").alias("Id"), F.col("Detail").alias("d"))
    joined = (
        index.join(detail, "Id", "left")
        .withColumnRenamed("Id", "fund_id")
        .join(classes, "fund_id", "left")
    )
    amount, fee, pct = (
        text.whole_number_value,
        text.fee_percent_value,
        text.decimal_number_value,
    )
    ipo_date = text.first_given(F.col("d.IpoDate"), F.col("IpoDate"))
    return joined.select(
        "fund_id",
        F.col("InvestmentManagerId").alias("manager_id"),
        F.col("CustodianBankId").alias("bank_id"),
        "class_group_id",
        F.col("Name").alias("name"),
        text.class_name(F.col("Name")).alias("class_name"),
        text.name_without_suffix(F.col("Name")).alias("base_name"),
        text.blank_to_null(F.col("IsinCode")).alias("isin_code"),
        text.blank_to_null(F.col("BloombergQuote")).alias("bloomberg_quote"),
        F.col("Type").alias("fund_type"),
        F.when(F.col("Currency").isNull(), F.lit(0))
        .otherwise(F.try_variant_get("Currency", "$", "int"))
        .alias("currency"),
        text.flag_value(F.col("Sharia"), absent=False).alias("is_sharia"),
        text.flag_value(F.col("ExchangeTradedFund"), absent=False).alias("is_etf"),
        text.flag_value(F.col("Index"), absent=False).alias("is_index"),
        text.flag_value(F.col("Dividend"), absent=False).alias("has_dividend"),
        text.flag_value(F.col("d.IsActive"), absent=True).alias("is_active"),
        dates.parse_date(ipo_date).alias("ipo_date"),
        F.col("d.Description").alias("description"),
        F.col("d.OfficialBenchmark").alias("official_benchmark"),
        amount(F.col("d.MinSubNum")).alias("min_subscription"),
        amount(F.col("d.MinNextSubNum")).alias("min_next_subscription"),
        amount(F.col("d.MinRedNum")).alias("min_redemption"),
        amount(F.col("d.MinBalanceNum")).alias("min_balance"),
        fee(F.col("d.MaxSubscriptionFee")).alias("sub_fee_max_pct"),
        fee(F.col("d.MaxRedemptionFee")).alias("red_fee_max_pct"),
        fee(F.col("d.MaxSwitchingFee")).alias("switching_fee_max_pct"),
        fee(F.col("d.MaxInvestmentManagerFee")).alias("manager_fee_max_pct"),
        fee(F.col("d.MaxCustodianBankFee")).alias("custodian_fee_max_pct"),
        pct(F.col("d.InvestmentBond")).alias("policy_bond_pct"),
        pct(F.col("d.InvestmentEquity")).alias("policy_equity_pct"),
        pct(F.col("d.InvestmentMoneyMarket")).alias("policy_money_market_pct"),
        dates.parse_date(F.col("LastUpdate")).alias("last_update"),
        F.col("ConservativeCategory").alias("source_label"),
        "pos",
        lost_cells(
            {
                **_lost_date("ipo_date", ipo_date),
                **_lost_date("last_update", F.col("LastUpdate")),
                **_lost_number("min_subscription", F.col("d.MinSubNum")),
                **_lost_number("min_next_subscription", F.col("d.MinNextSubNum")),
                **_lost_number("min_redemption", F.col("d.MinRedNum")),
                **_lost_number("min_balance", F.col("d.MinBalanceNum")),
            }
        ),
    ).withColumn(
        "conservative_label",
        labels.conservative_label(F.col("fund_type"), F.col("is_index"), F.col("is_etf")),
    )


def fund_classes(fund_rows: DataFrame) -> DataFrame:
    """Name of each class group: that of its first fund in index order."""
    grouped = fund_rows.filter("class_group_id IS NOT NULL")
    return first_per_key(grouped, ["class_group_id"], [F.col("pos")]).select(
        "class_group_id", "base_name"
    )


def _by_fund(snapshots: DataFrame) -> DataFrame:
    keyed = snapshots.withColumn("fund_id", F.col("file_key").try_cast("int"))
    return keyed.filter("fund_id <> 0")


def nav(snapshots: DataFrame) -> DataFrame:
    points = _by_fund(snapshots).select("fund_id", F.posexplode("NetAssetValues").alias("pos", "n"))
    rows = points.select(
        "fund_id",
        dates.parse_date(F.col("n.Date")).alias("record_date"),
        F.col("n.Value").alias("nav_value"),
        F.col("n.ClassTotalValue").alias("class_total_value"),
        "pos",
    )
    return mark_rejects(
        rows,
        {
            "no value": F.col("nav_value").isNull(),
            "value not positive": F.col("nav_value") <= 0,
            "no date": F.col("record_date").isNull(),
        },
    )


def aum(snapshots: DataFrame) -> DataFrame:
    """Monthly values with the units of the same date, from two arrays of one
    document.  Units may repeat a date; the last one counts.

    Both sides grow with the documents, so the units are never broadcast: the wide
    documents that they are a small part of make the planner take them for few.
    """
    funds_ = _by_fund(snapshots)
    values = funds_.select("fund_id", F.posexplode("AssetUnderManagements").alias("pos", "a"))
    units = (
        funds_.select("fund_id", F.posexplode("TotalUnits").alias("pos", "u"))
        .groupBy("fund_id", dates.parse_date(F.col("u.Date")).alias("record_date"))
        .agg(F.max_by("u.Value", "pos").alias("total_units"))
    )
    rows = values.select(
        "fund_id",
        dates.parse_date(F.col("a.Date")).alias("record_date"),
        F.col("a.Value").alias("_value"),
        F.col("a.ClassTotalValue").try_cast("bigint").alias("class_total_value"),
        "pos",
    ).join(units.hint("merge"), ["fund_id", "record_date"], "left")
    return mark_rejects(
        rows.withColumn("aum_value", F.col("_value").try_cast("bigint")).withColumn(
            "published_date", dates.published_date(F.col("record_date"))
        ),
        {
            "no value": F.col("_value").isNull(),
            "negative value": F.col("_value") < 0,
            "no date": F.col("record_date").isNull(),
        },
    ).drop("_value")


def portfolio_snapshots(documents: DataFrame, valid: DataFrame) -> DataFrame:
    """Dated portfolios of known funds, with their lines still nested."""
    return (
        documents.select(
            F.col("file_key").try_cast("int").alias("fund_id"),
            dates.parse_date(F.col("DateBased")).alias("date_based"),
            text.decimal_number_value(F.col("DomesticAllocation")).alias("domestic_allocation_pct"),
            text.decimal_number_value(F.col("ForeignAllocation")).alias("foreign_allocation_pct"),
            "Assets",
            "file_name",
            "pos",
        )
        .filter("date_based IS NOT NULL")
        .join(valid.select("fund_id"), "fund_id", "left_semi")
    )


def portfolio_lines(snapshots: DataFrame) -> DataFrame:
    """All lines of all portfolios, once.  Write it out and derive the category,
    security, allocation and holding tables from it."""
    lines = snapshots.select(
        "fund_id", "date_based", "file_name", "pos", F.posexplode("Assets").alias("line", "a")
    )
    stock = F.col("a.Type") == STOCK_LINE
    code = F.when(stock, F.col("a.Stock.Code")).otherwise(F.col("a.Name"))
    stock_name = text.first_given(F.col("a.Stock.Name"), F.col("a.Name"))
    return lines.select(
        "fund_id",
        "date_based",
        F.col("a.Type").alias("line_type"),
        F.col("a.SpesificType").alias("category_id"),
        F.nullif(code, F.lit("")).alias("code"),
        F.when(stock, stock_name).otherwise(F.col("a.Name")).alias("name"),
        F.when(stock, F.col("a.fkStockId")).alias("source_stock_id"),
        F.col("a.Value").try_cast(PERCENT).alias("value_pct"),
        "file_name",
        "pos",
        "line",
    )


LINE_ORDER = ["file_name", "pos", "line"]


def _is_instrument() -> Column:
    return F.col("line_type").isin(STOCK_LINE, BOND_LINE) & F.col("code").isNotNull()


def _is_category() -> Column:
    return (F.col("line_type") == CATEGORY_LINE) & F.col("category_id").isNotNull()


def categories(lines: DataFrame) -> DataFrame:
    rows = lines.filter(_is_category())
    return first_per_key(rows, ["category_id"], [F.col(c) for c in LINE_ORDER]).select(
        "category_id", "name"
    )


def securities(lines: DataFrame) -> DataFrame:
    """Instruments by code; the first mention gives the other columns."""
    rows = lines.filter(_is_instrument())
    return first_per_key(rows, ["code"], [F.col(c) for c in LINE_ORDER]).select(
        "code", "name", F.col("line_type").alias("security_type"), "source_stock_id"
    )


def in_percent_range() -> Column:
    return F.col("value_pct").between(0, 100)


def dropped_lines(lines: DataFrame) -> DataFrame:
    """Number of lines per kind that :func:`allocations` and :func:`holdings` leave out,
    with the reason."""
    used = _is_category() | _is_instrument()
    reason = (
        F.when(~F.coalesce(used, F.lit(False)), F.lit("no category or code"))
        .when(F.col("value_pct").isNull(), F.lit("no value"))
        .when(~in_percent_range(), F.lit("outside 0..100"))
    )
    marked = lines.withColumn("reason", reason).filter("reason IS NOT NULL")
    return marked.groupBy("line_type", "reason").agg(F.count("*").alias("n_lines"))


def allocations(lines: DataFrame) -> DataFrame:
    rows = lines.filter(_is_category() & in_percent_range())
    return sum_duplicates(
        rows.select("fund_id", "date_based", "category_id", "value_pct"),
        ["fund_id", "date_based", "category_id"],
        "value_pct",
    )


def holdings(lines: DataFrame) -> DataFrame:
    """Instrument lines, added up per portfolio and code where they are read, so
    a later join on the code moves one row per portfolio and instrument."""
    rows = lines.filter(_is_instrument() & in_percent_range())
    return sum_duplicates(
        rows.select("fund_id", "date_based", "code", "value_pct"),
        ["fund_id", "date_based", "code"],
        "value_pct",
    )


# Source names of the performance metrics.
METRIC_FIELDS = dict(
    zip(
        METRIC_COLUMNS,
        (
            "Return",
            "StandardDeviation",
            "Beta",
            "SharpeRatio",
            "ModifiedSharpeRatio",
            "TreynorRatio",
            "SortinoRatio",
            "TrackingError",
            "MaxDrawdown",
            "Cagr",
            "JensenAlpha",
        ),
    )
)


def _dated(snapshots: DataFrame, items: str) -> DataFrame:
    """Elements of an array with the latest value date of their document; all
    dates count, also those of values that are rejected."""
    return _by_fund(snapshots).select(
        "fund_id",
        dates.latest_date(F.col("NetAssetValues"), "Date").alias("as_of_date"),
        F.posexplode(items).alias("pos", "m"),
    )


def performance(snapshots: DataFrame) -> DataFrame:
    rows = _dated(snapshots, "Performances").select(
        "fund_id",
        F.try_variant_get("m.Period", "$", "int").alias("period_code"),
        "as_of_date",
        *[F.col(f"m.{source}").alias(out) for out, source in METRIC_FIELDS.items()],
        "pos",
    )
    return rows.filter(given(["period_code", "as_of_date"]))


def ranking(snapshots: DataFrame, rating_field: str) -> DataFrame:
    category = F.when(F.col("m.Category").isNull(), F.lit(0)).otherwise(
        F.try_variant_get("m.Category", "$", "int")
    )
    rows = _dated(snapshots, "Rankings").select(
        "fund_id",
        F.try_variant_get("m.Period", "$", "int").alias("period_code"),
        category.alias("category_code"),
        "as_of_date",
        F.col("m.RiskRank").alias("risk_rank"),
        F.col("m.RatingRank").alias("rating_rank"),
        F.col("m.AllRiskRank").alias("all_risk_rank"),
        F.col(f"m.{rating_field}").alias("provider_rating"),
        F.col("m.RiskRating").alias("risk_rating"),
        F.col("m.AllRiskRating").alias("all_risk_rating"),
        "pos",
    )
    return rows.filter(given(["period_code", "as_of_date"]))


def fund_benchmarks(snapshots: DataFrame) -> DataFrame:
    """All benchmark mentions of all funds, with their points still nested."""
    rows = _by_fund(snapshots).select(
        "fund_id",
        "file_name",
        F.col("Benchmark.Id").alias("official_id"),
        F.posexplode("Benchmarks").alias("pos", "b"),
    )
    return rows.select(
        "fund_id",
        F.col("b.Id").alias("benchmark_id"),
        F.col("b.Name").alias("name"),
        F.coalesce(F.col("b.Id") == F.col("official_id"), F.lit(False)).alias("is_official"),
        F.col("b.Data").alias("points"),
        "file_name",
        "pos",
    ).filter("benchmark_id IS NOT NULL")


def benchmarks(mentions: DataFrame) -> DataFrame:
    """Benchmark names; the last mention wins."""
    return last_per_key(mentions, ["benchmark_id"], ["file_name", "pos"]).select(
        "benchmark_id", "name"
    )


def benchmark_points(mentions: DataFrame) -> DataFrame:
    """Points per benchmark and date: the first one that has a value."""
    points = mentions.select(
        "benchmark_id", "file_name", "pos", F.posexplode("points").alias("point", "d")
    ).select(
        "benchmark_id",
        dates.parse_date(F.col("d.Date")).alias("record_date"),
        F.col("d.Value").alias("value"),
        "file_name",
        "pos",
        "point",
    )
    dated = points.filter(given(["record_date", "value"]))
    order = [F.col("file_name"), F.col("pos"), F.col("point")]
    return first_per_key(dated, ["benchmark_id", "record_date"], order).select(
        "benchmark_id", "record_date", "value"
    )


def benchmark_links(mentions: DataFrame) -> DataFrame:
    order = [F.col("file_name"), F.col("pos")]
    return first_per_key(mentions, ["fund_id", "benchmark_id"], order).select(
        "fund_id", "benchmark_id", "is_official"
    )


def quarterly_returns(documents: DataFrame, valid: DataFrame) -> DataFrame:
    """Quarters of known funds; the fund id is the first part of the file name."""
    fund_id = F.split_part("file_key", F.lit("_"), F.lit(1)).try_cast("int")
    rows = documents.select(
        fund_id.alias("fund_id"),
        dates.parse_date(F.col("Date")).alias("quarter_start"),
        F.col("Value").alias("return_pct"),
        "file_name",
        "pos",
    ).join(valid.select("fund_id"), "fund_id", "left_semi")
    return mark_rejects(
        rows,
        {
            "quarter not run yet": F.col("return_pct").isNull(),
            "no date": F.col("quarter_start").isNull(),
        },
    )


def fund_sales(documents: DataFrame, valid: DataFrame) -> DataFrame:
    """Fund to sales company links of known funds; the last fee wins."""
    links = documents.select(
        "file_name",
        "pos",
        F.posexplode("FundSalesCompany.FundSalesCompanyFunds").alias("link_pos", "link"),
    ).select(
        F.col("link.fkFundId").alias("fund_id"),
        F.col("link.fkFundSalesCompanyId").alias("company_id"),
        F.col("link.CommissionFee").alias("commission_fee"),
        "file_name",
        "pos",
        "link_pos",
    )
    # One link per fund and company before the join on the fund alone, which
    # would gather all links of a fund in one task.
    order = ["file_name", "pos", "link_pos"]
    single = last_per_key(links, ["fund_id", "company_id"], order)
    known = single.join(valid.select("fund_id"), "fund_id", "left_semi")
    return known.select("fund_id", "company_id", "commission_fee")
