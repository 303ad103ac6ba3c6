"""Table contracts: schema, key, write mode and the rules rows must meet.

The contracts are data; :mod:`dimflow.plans.load` and
:func:`contract_checks` read them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPSERT = "upsert"
INSERT = "insert if absent"
CHILDREN = "replace children"


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: str
    key: tuple[str, ...]
    mode: str = UPSERT
    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    widths: dict[str, int] = field(default_factory=dict)
    parents: dict[str, tuple[str, str]] = field(default_factory=dict)
    restricted: tuple[str, ...] = ()  # foreign keys whose parent cannot be deleted
    surrogate: str | None = None
    span: str | None = None
    cluster: tuple[str, ...] = ()
    slice: str | None = None
    audited: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def stamped(self) -> bool:
        return "scraped_at" in self.schema.fieldNames()

    @property
    def layout(self) -> tuple[str, ...]:
        return self.cluster or self.key


def _pct(*columns: str) -> dict[str, str]:
    return {f"{c} in 0..100": f"{c} BETWEEN 0 AND 100" for c in columns}


def _sign(*columns: str) -> dict[str, str]:
    return {f"{c} not negative": f"{c} >= 0" for c in columns}


def _positive(*columns: str) -> dict[str, str]:
    return {f"{c} positive": f"{c} > 0" for c in columns}


CONTACT_WIDTHS = {"telephone": 50, "fax": 50, "email": 100, "website_url": 255}
FEE_COLUMNS = (
    "sub_fee_max_pct",
    "red_fee_max_pct",
    "switching_fee_max_pct",
    "manager_fee_max_pct",
    "custodian_fee_max_pct",
)
POLICY_COLUMNS = ("policy_bond_pct", "policy_equity_pct", "policy_money_market_pct")
AMOUNT_COLUMNS = (
    "min_subscription",
    "min_next_subscription",
    "min_redemption",
    "min_balance",
)
METRIC_COLUMNS = (
    "return_pct",
    "std_dev",
    "beta",
    "sharpe_ratio",
    "modified_sharpe_ratio",
    "treynor_ratio",
    "sortino_ratio",
    "tracking_error",
    "max_drawdown",
    "cagr",
    "jensen_alpha",
)
RANK_COLUMNS = ("risk_rank", "rating_rank", "all_risk_rank")
RATING_COLUMNS = ("provider_rating", "risk_rating", "all_risk_rating")

# Slices: what a batch touches of a table is written anew by these.
MONTH = "date_format({}, 'yyyy-MM')"
MANAGERS = "manager_id DIV 1000"
VERSIONS = "if(is_current, 'current', 'closed')"

TO_MANAGER = {"manager_id": ("investment_manager", "manager_id")}
TO_FUND = {"fund_id": ("mutual_fund", "fund_id")}
TO_SNAPSHOT = {"snapshot_id": ("portfolio_snapshot", "snapshot_id")}


def _typed(columns: tuple[str, ...], kind: str) -> str:
    return ", ".join(f"{c} {kind}" for c in columns)


# Tables in load order: a table comes after the tables it refers to.
RELATIONAL = (
    TableContract(
        "investment_manager",
        "manager_id int, name string, ojk_code string, mi_permit_num string, "
        "ppe_permit_num string, pee_permit_num string, description string, address string, "
        "telephone string, fax string, email string, website_url string, capital bigint, "
        "paid_in_capital bigint, is_active boolean, data_last_update date, scraped_at timestamp",
        key=("manager_id",),
        not_null=("name", "ojk_code", "is_active"),
        unique=(("ojk_code",),),
        checks=_sign("capital", "paid_in_capital"),
        widths={
            "name": 255,
            "ojk_code": 20,
            "mi_permit_num": 150,
            "ppe_permit_num": 150,
            "pee_permit_num": 150,
            **CONTACT_WIDTHS,
        },
        audited=True,
    ),
    TableContract(
        "custodian_bank",
        "bank_id int, name string, ojk_code string, description string, address string, "
        "telephone string, fax string, email string, website_url string, niu_bank_umum string, "
        "niu_bk string, date_start_sk string, ownership_status string, activity_status string, "
        "is_active boolean, data_last_update date, scraped_at timestamp",
        key=("bank_id",),
        not_null=("name", "is_active"),
        unique=(("ojk_code",),),
        widths={
            "name": 255,
            "ojk_code": 20,
            "niu_bank_umum": 100,
            "niu_bk": 100,
            "date_start_sk": 50,
            "ownership_status": 30,
            "activity_status": 30,
            **CONTACT_WIDTHS,
        },
        audited=True,
    ),
    TableContract(
        "sales_company",
        "company_id int, name string, aperd_id string, npwp string, no_sttd_sk string, "
        "date_sttd_sk string, address string, telephone string, fax string, email string, "
        "website_url string, contact_person string, scraped_at timestamp",
        key=("company_id",),
        not_null=("name", "aperd_id"),
        unique=(("aperd_id",),),
        widths={
            "name": 255,
            "aperd_id": 20,
            "npwp": 30,
            "no_sttd_sk": 100,
            "date_sttd_sk": 50,
            "contact_person": 255,
            **CONTACT_WIDTHS,
        },
        audited=True,
    ),
    TableContract(
        "benchmark",
        "benchmark_id int, name string",
        key=("benchmark_id",),
        mode=INSERT,
        not_null=("name",),
        unique=(("name",),),
        widths={"name": 100},
    ),
    TableContract(
        "asset_category",
        "category_id smallint, name string",
        key=("category_id",),
        not_null=("name",),
        unique=(("name",),),
        widths={"name": 50},
    ),
    TableContract(
        "security",
        "security_id bigint, code string, name string, security_type smallint, "
        "source_stock_id int",
        key=("security_id",),
        not_null=("code", "name", "security_type"),
        unique=(("code",),),
        checks={"security_type is 1 or 2": "security_type IN (1, 2)"},
        widths={"code": 255, "name": 255},
        surrogate="security_id",
        cluster=("code",),
        audited=True,
    ),
    TableContract(
        "fund_class",
        "class_group_id int, base_name string",
        key=("class_group_id",),
        not_null=("base_name",),
        widths={"base_name": 255},
        audited=True,
    ),
    TableContract(
        "manager_personnel",
        "personnel_id bigint, manager_id int, name string, title string",
        key=("manager_id",),
        mode=CHILDREN,
        not_null=("manager_id", "name", "title"),
        widths={"name": 255, "title": 100},
        parents=TO_MANAGER,
        surrogate="personnel_id",
        cluster=("manager_id", "name"),
        slice=MANAGERS,
    ),
    TableContract(
        "manager_shareholder",
        "shareholder_id bigint, manager_id int, shareholder_name string, share_amount bigint",
        key=("manager_id",),
        mode=CHILDREN,
        not_null=("manager_id", "shareholder_name"),
        checks=_sign("share_amount"),
        widths={"shareholder_name": 255},
        parents=TO_MANAGER,
        surrogate="shareholder_id",
        cluster=("manager_id", "shareholder_name"),
        slice=MANAGERS,
    ),
    TableContract(
        "manager_aum_record",
        "manager_id int, record_date date, aum_value decimal(20,2), total_units decimal(20,4), "
        "scraped_at timestamp",
        key=("manager_id", "record_date"),
        mode=INSERT,
        not_null=("aum_value",),
        checks=_sign("aum_value", "total_units"),
        parents=TO_MANAGER,
        span="record_date",
        cluster=("record_date", "manager_id"),
    ),
    TableContract(
        "mutual_fund",
        "fund_id int, manager_id int, bank_id int, class_group_id int, name string, "
        "class_name string, isin_code string, bloomberg_quote string, fund_type smallint, "
        "currency smallint, is_sharia boolean, is_etf boolean, is_index boolean, "
        "has_dividend boolean, is_active boolean, ipo_date date, description string, "
        "official_benchmark string, "
        + _typed(AMOUNT_COLUMNS, "bigint")
        + ", "
        + _typed(FEE_COLUMNS, "decimal(6,4)")
        + ", "
        + _typed(POLICY_COLUMNS, "decimal(5,2)")
        + ", last_update date, scraped_at timestamp, conservative_label string",
        key=("fund_id",),
        not_null=("manager_id", "bank_id", "name", "fund_type", "currency", "is_active"),
        unique=(("isin_code",),),
        checks={**_sign(*AMOUNT_COLUMNS), **_pct(*FEE_COLUMNS, *POLICY_COLUMNS)},
        widths={
            "name": 255,
            "class_name": 50,
            "isin_code": 20,
            "bloomberg_quote": 50,
            "official_benchmark": 255,
        },
        parents={
            **TO_MANAGER,
            "bank_id": ("custodian_bank", "bank_id"),
            "class_group_id": ("fund_class", "class_group_id"),
        },
        restricted=("manager_id", "bank_id", "class_group_id"),
        audited=True,
    ),
    TableContract(
        "nav_record",
        "fund_id int, record_date date, nav_value decimal(18,4), "
        "class_total_value decimal(18,4), scraped_at timestamp",
        key=("fund_id", "record_date"),
        mode=INSERT,
        not_null=("nav_value",),
        checks=_positive("nav_value"),
        parents=TO_FUND,
        span="record_date",
        cluster=("record_date", "fund_id"),
    ),
    TableContract(
        "aum_record",
        "fund_id int, record_date date, published_date date, aum_value bigint, "
        "total_units decimal(18,4), class_total_value bigint, scraped_at timestamp",
        key=("fund_id", "record_date"),
        mode=INSERT,
        not_null=("aum_value",),
        checks=_sign("aum_value", "total_units"),
        parents=TO_FUND,
        span="record_date",
        cluster=("record_date", "fund_id"),
    ),
    TableContract(
        "portfolio_snapshot",
        "snapshot_id bigint, fund_id int, date_based date, "
        "domestic_allocation_pct decimal(5,2), foreign_allocation_pct decimal(5,2), "
        "scraped_at timestamp",
        key=("fund_id", "date_based"),
        mode=INSERT,
        unique=(("snapshot_id",),),
        checks=_pct("domestic_allocation_pct", "foreign_allocation_pct"),
        parents=TO_FUND,
        surrogate="snapshot_id",
    ),
    TableContract(
        "fund_performance",
        "fund_id int, period_code smallint, as_of_date date, "
        + _typed(METRIC_COLUMNS, "decimal(12,8)"),
        key=("fund_id", "period_code", "as_of_date"),
        parents=TO_FUND,
        cluster=("as_of_date", "fund_id"),
        slice=MONTH.format("as_of_date"),
    ),
    TableContract(
        "fund_ranking",
        "fund_id int, period_code smallint, category_code smallint, as_of_date date, "
        + _typed(RANK_COLUMNS, "int")
        + ", "
        + _typed(RATING_COLUMNS, "decimal(3,1)"),
        key=("fund_id", "period_code", "category_code", "as_of_date"),
        checks={
            **_positive(*RANK_COLUMNS),
            **{f"{c} in 1..5": f"{c} BETWEEN 1 AND 5" for c in RATING_COLUMNS},
        },
        parents=TO_FUND,
        cluster=("as_of_date", "fund_id"),
        slice=MONTH.format("as_of_date"),
    ),
    TableContract(
        "fund_quarterly_return",
        "fund_id int, quarter_start date, return_pct decimal(12,8)",
        key=("fund_id", "quarter_start"),
        parents=TO_FUND,
        cluster=("quarter_start", "fund_id"),
        slice="year(quarter_start)",
    ),
    TableContract(
        "benchmark_data_point",
        "benchmark_id int, record_date date, value decimal(18,8)",
        key=("benchmark_id", "record_date"),
        mode=INSERT,
        not_null=("value",),
        parents={"benchmark_id": ("benchmark", "benchmark_id")},
        span="record_date",
        cluster=("record_date", "benchmark_id"),
    ),
    TableContract(
        "fund_benchmark",
        "fund_id int, benchmark_id int, is_official boolean",
        key=("fund_id", "benchmark_id"),
        not_null=("is_official",),
        parents={**TO_FUND, "benchmark_id": ("benchmark", "benchmark_id")},
    ),
    TableContract(
        "fund_sales_company",
        "fund_id int, company_id int, commission_fee decimal(6,4)",
        key=("fund_id", "company_id"),
        checks=_pct("commission_fee"),
        parents={**TO_FUND, "company_id": ("sales_company", "company_id")},
    ),
    TableContract(
        "portfolio_allocation",
        "allocation_id bigint, snapshot_id bigint, category_id smallint, value_pct decimal(8,4)",
        key=("snapshot_id", "category_id"),
        mode=INSERT,
        not_null=("value_pct",),
        checks=_pct("value_pct"),
        parents={**TO_SNAPSHOT, "category_id": ("asset_category", "category_id")},
        restricted=("category_id",),
        surrogate="allocation_id",
    ),
    TableContract(
        "portfolio_holding",
        "holding_id bigint, snapshot_id bigint, security_id bigint, value_pct decimal(8,4)",
        key=("snapshot_id", "security_id"),
        mode=INSERT,
        not_null=("value_pct",),
        checks=_pct("value_pct"),
        parents={**TO_SNAPSHOT, "security_id": ("security", "security_id")},
        restricted=("security_id",),
        surrogate="holding_id",
        cluster=("security_id", "snapshot_id"),
    ),
)

AUDIT_LOG = TableContract(
    "audit_log",
    "table_name string, record_pk string, changed_at timestamp, old_values string, "
    "new_values string, changed_by string",
    key=("table_name", "record_pk", "changed_at"),
    mode=INSERT,
)

REJECT_LOG = TableContract(
    "reject_log",
    "table_name string, record_pk string, reject_reason string, batch string",
    key=("batch", "table_name", "record_pk"),
    mode=INSERT,
)

# Values of the source that a table cannot hold, once each.
CELL_LOG = TableContract(
    "cell_log",
    "table_name string, record_pk string, column_name string, raw_value string, reason string, "
    "batch string",
    key=("table_name", "record_pk", "column_name", "raw_value"),
    mode=INSERT,
    cluster=("table_name", "record_pk"),
)

# Count, mean and squared deviations of the daily returns of a label, a month and a
# bucket of funds, with a bitmap of these funds; rows of one key are merged when read.
MOMENTS = TableContract(
    "category_moments",
    "label string, month int, bucket bigint, n bigint, mean double, m2 double, funds binary",
    key=("month", "label", "bucket"),
    mode=INSERT,
)

# Source rows that no fact could be made of yet, as a dimension misses their key.
WAITING = TableContract(
    "fact_waiting",
    "fact string, owner_id int, record_date date",
    key=("fact", "record_date", "owner_id"),
)

STAR_KEYS = (
    "dim_fund_key bigint, dim_manager_key bigint, category_id bigint, dim_custodian_key bigint"
)

STAR = (
    TableContract(
        "dim_date",
        "date_id int, full_date date, day smallint, day_name string, week smallint, "
        "month smallint, month_name string, quarter smallint, year smallint, is_weekday boolean",
        key=("date_id",),
        mode=INSERT,
        unique=(("full_date",),),
    ),
    TableContract(
        "dim_category",
        "category_id bigint, label string, fund_type_code smallint",
        key=("label", "fund_type_code"),
        mode=INSERT,
        surrogate="category_id",
    ),
    TableContract(
        "dim_fund",
        "dim_fund_key bigint, fund_id int, name string, class_name string, isin_code string, "
        "currency_code string, is_sharia boolean, is_etf boolean, is_index boolean, "
        "official_benchmark string, ipo_date date, valid_from date, valid_to date, "
        "is_current boolean",
        key=("fund_id",),
        surrogate="dim_fund_key",
        slice=VERSIONS,
    ),
    TableContract(
        "dim_manager",
        "dim_manager_key bigint, manager_id int, name string, ojk_code string, "
        "is_active boolean, valid_from date, valid_to date, is_current boolean",
        key=("manager_id",),
        surrogate="dim_manager_key",
        slice=VERSIONS,
    ),
    TableContract(
        "dim_custodian",
        "dim_custodian_key bigint, bank_id int, name string, ownership_status string, "
        "valid_from date, valid_to date, is_current boolean",
        key=("bank_id",),
        surrogate="dim_custodian_key",
        slice=VERSIONS,
    ),
    TableContract(
        "fact_nav_daily",
        f"date_id int, fund_id int, {STAR_KEYS}, nav_value decimal(18,4), "
        "daily_return decimal(12,8)",
        key=("date_id", "fund_id"),
        mode=INSERT,
    ),
    TableContract(
        "fact_aum_monthly",
        f"date_id int, fund_id int, {STAR_KEYS}, aum_value bigint, total_units decimal(18,4)",
        key=("date_id", "fund_id"),
        mode=INSERT,
    ),
    TableContract(
        "fact_manager_aum_monthly",
        "date_id int, manager_id int, dim_manager_key bigint, aum_value decimal(20,2), "
        "total_units decimal(20,4)",
        key=("date_id", "manager_id"),
        mode=INSERT,
    ),
    TableContract(
        "latest_nav",
        "fund_id int, record_date date, nav_value decimal(18,4), daily_return decimal(38,19)",
        key=("fund_id",),
    ),
)

CONTRACTS = {c.name: c for c in (*RELATIONAL, AUDIT_LOG, REJECT_LOG, CELL_LOG, WAITING, MOMENTS, *STAR)}


def contract_checks(contract: TableContract) -> dict[str, Column]:
    """Conditions every row of the table must meet, by name."""
    checks = {}
    for column in dict.fromkeys((*contract.key, *contract.not_null)):
        checks[f"{column} given"] = F.col(column).isNotNull()
    for column, width in contract.widths.items():
        checks[f"{column} fits {width}"] = F.char_length(column) <= width
    for name, condition in contract.checks.items():
        checks[name] = F.expr(condition)
    return checks


def conform(
    df: DataFrame, contract: TableContract, keep: tuple[str, ...] = (), *more: Column
) -> DataFrame:
    """Columns of the contract in order and type, the columns to keep as they
    are, and more.  A value that does not fit its type becomes null."""
    present = set(df.columns)
    typed = [
        (F.col(f.name) if f.name in present else F.lit(None)).try_cast(f.dataType).alias(f.name)
        for f in contract.schema
    ]
    return df.select(*typed, *[c for c in keep if c in present], *more)


def misfits(df: DataFrame, contract: TableContract) -> dict[str, Column]:
    """Conditions under which a given value is lost by :func:`conform`."""
    return {
        f"{f.name} does not fit": F.col(f.name).isNotNull()
        & F.col(f.name).try_cast(f.dataType).isNull()
        for f in contract.schema
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType
    }
