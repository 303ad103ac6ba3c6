"""Cleaning steps over text that is written from the driver's tables the way
the sources write it."""

from __future__ import annotations

from pyspark.sql import functions as F

from dimflow.functions import checks, dates, labels, text
from dimflow.operators.dedup import distinct_names
from dimflow.operators.dedup import keep_first_code as first_code
from dimflow.operators.quality import drop_zero_rows, label_consistency as consistency
from workload.tables import query


@query(
    """
    SELECT p_partkey, raw, NULLIF(NULLIF(TRIM(raw), ''), '-') AS cleaned,
           NULLIF(TRIM(raw), '') AS dash_kept
    FROM (SELECT p_partkey, CASE WHEN p_retailprice < 920 THEN ' - ' WHEN p_size > 40 THEN '   '
                 ELSE '  ' || p_name || ' ' END AS raw FROM part)
    """
)
def clean_text_null(t):
    raw = (
        F.when(F.col("p_retailprice") < 920, F.lit(" - "))
        .when(F.col("p_size") > 40, F.lit("   "))
        .otherwise(F.concat(F.lit("  "), "p_name", F.lit(" ")))
    )
    return t.part.select("p_partkey", raw.alias("raw")).select(
        "p_partkey",
        "raw",
        text.blank_to_null(F.col("raw")).alias("cleaned"),
        text.blank_to_null(F.col("raw"), dash_null=False).alias("dash_kept"),
    )


@query(
    """
    SELECT o_orderkey, raw,
           TRY_CAST(NULLIF(NULLIF(REGEXP_REPLACE(raw, '[^0-9-]', '', 'g'), ''), '-') AS BIGINT)
             AS amount
    FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '-'
                 ELSE 'Rp ' || REPLACE(FORMAT('{:,}', CAST(FLOOR(o_totalprice) AS BIGINT)),
                                       ',', '.') END AS raw FROM orders)
    """
)
def clean_money(t):
    whole = F.translate(F.format_number(F.floor("o_totalprice"), 0), ",", ".")
    raw = F.when(F.col("o_orderstatus") == "P", F.lit("-")).otherwise(
        F.concat(F.lit("Rp "), whole)
    )
    return t.orders.select("o_orderkey", raw.alias("raw")).withColumn(
        "amount", text.whole_number(F.col("raw"))
    )


_PERCENT_SQL = "REPLACE(CAST(CAST(p_retailprice AS DECIMAL(10, 2)) AS VARCHAR), '.', ',')"


@query(
    f"""
    SELECT p_partkey, {_PERCENT_SQL} || '%' AS raw,
           CAST(REPLACE({_PERCENT_SQL}, ',', '.') AS DOUBLE) AS pct
    FROM part
    """
)
def clean_decimal(t):
    written = F.translate(F.col("p_retailprice").cast("decimal(10,2)").cast("string"), ".", ",")
    raw = t.part.select("p_partkey", F.concat(written, F.lit("%")).alias("raw"))
    return raw.withColumn("pct", text.decimal_number(F.col("raw")))


@query(
    f"""
    SELECT p_partkey, raw,
           TRY_CAST(NULLIF(REGEXP_EXTRACT(REPLACE(raw, ',', '.'), '(-?\\d+\\.?\\d*)', 1), '')
             AS DOUBLE) AS fee_pct
    FROM (SELECT p_partkey, CASE WHEN p_size > 40 THEN 'n/a'
                 ELSE 'Maks ' || {_PERCENT_SQL} || '%' END AS raw FROM part)
    """
)
def clean_fee(t):
    written = F.translate(F.col("p_retailprice").cast("decimal(10,2)").cast("string"), ".", ",")
    raw = F.when(F.col("p_size") > 40, F.lit("n/a")).otherwise(
        F.concat(F.lit("Maks "), written, F.lit("%"))
    )
    return t.part.select("p_partkey", raw.alias("raw")).withColumn(
        "fee_pct", text.fee_percent(F.col("raw"))
    )


@query(
    """
    SELECT o_orderkey, order_day, LAST_DAY(order_day) AS published_date,
           CAST(STRFTIME(order_day, '%Y%m%d') AS INTEGER) AS date_id
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END
                 AS order_day FROM orders)
    """
)
def clean_dates(t):
    """ISO text for one status, day-first text for another, unknown text else."""
    raw = (
        F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd-MM-yyyy"))
        .otherwise(F.lit("not-a-date"))
    )
    parsed = t.orders.select("o_orderkey", dates.parse_date(raw).alias("order_day"))
    return parsed.select(
        "o_orderkey",
        "order_day",
        dates.published_date(F.col("order_day")).alias("published_date"),
        dates.date_key(F.col("order_day")).alias("date_id"),
    )


@query(
    """
    SELECT p_partkey, p_name AS base_name,
           CASE WHEN p_size > 25 THEN 'Kelas ' || p_brand END AS class_name
    FROM part
    """
)
def split_suffix(t):
    suffix = F.concat(F.lit("  kELAS "), "p_brand")
    full = F.when(F.col("p_size") > 25, F.concat("p_name", suffix)).otherwise(F.col("p_name"))
    named = t.part.select("p_partkey", full.alias("full"))
    return named.select(
        "p_partkey",
        text.name_without_suffix(F.col("full")).alias("base_name"),
        text.class_name(F.col("full")).alias("class_name"),
    )


def typed_orders(t):
    """Orders as typed funds: type from the priority, flags from price and status."""
    digit = F.left("o_orderpriority", F.lit(1)).cast("int")
    return t.orders.select(
        "o_orderkey",
        "o_orderdate",
        F.when(digit == 5, 7).otherwise(digit).cast("smallint").alias("fund_type"),
        (F.col("o_totalprice") > 480000).alias("is_index"),
        (F.col("o_orderstatus") == "O").alias("is_etf"),
        F.when(F.col("o_orderstatus") == "F", 0).otherwise(1).alias("currency"),
    )


LABEL_SQL = """
    SELECT o_orderkey, o_orderdate, o_totalprice, o_orderpriority, o_orderstatus, fund_type,
           CASE WHEN o_totalprice > 480000 THEN 'Indeks'
                WHEN fund_type = 7 AND o_orderstatus = 'O' THEN 'Exchange Traded Fund'
                WHEN fund_type = 7 THEN 'Reksadana Global'
                WHEN fund_type = 0 THEN 'Campuran'
                WHEN fund_type = 1 THEN 'Saham'
                WHEN fund_type = 2 THEN 'Pendapatan Tetap'
                WHEN fund_type = 3 THEN 'Pasar Uang'
                WHEN fund_type = 4 THEN 'Terproteksi' ELSE 'Lainnya' END AS label
    FROM (SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN 7
                         ELSE CAST(LEFT(o_orderpriority, 1) AS INTEGER) END AS fund_type
          FROM orders)
"""


def _label():
    return labels.conservative_label(F.col("fund_type"), F.col("is_index"), F.col("is_etf"))


@query(
    f"""
    SELECT o_orderkey, label, CASE o_orderstatus WHEN 'F' THEN 'IDR' ELSE 'USD' END AS currency_code
    FROM ({LABEL_SQL})
    """
)
def derive_label(t):
    return typed_orders(t).select(
        "o_orderkey",
        _label().alias("label"),
        labels.currency_code(F.col("currency")).alias("currency_code"),
    )


@query(
    f"""
    SELECT CAST(COUNT(*) AS BIGINT) AS checked,
           CAST(COUNT(*) FILTER (o_totalprice > 480000) AS BIGINT) AS mismatches,
           ROUND(COUNT(*) FILTER (o_totalprice > 480000) * 100.0 / COUNT(*), 6) AS mismatch_pct,
           COUNT(*) FILTER (o_totalprice > 480000) * 100.0 / COUNT(*) <= 5 AS rule_holds
    FROM ({LABEL_SQL})
    """
)
def label_consistency(t):
    """The given label ignores the index flag, the derived one does not."""
    rows = typed_orders(t)
    given = labels.conservative_label(F.col("fund_type"), F.lit(False), F.col("is_etf"))
    found = consistency(rows, _label(), given, F.col("fund_type").isNotNull())
    return found.withColumn("mismatch_pct", F.round("mismatch_pct", 6))


@query(
    """
    SELECT c_custkey,
           CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS min_amount,
           CASE WHEN c_acctbal < 5000 THEN c_acctbal END AS fee,
           CASE WHEN c_acctbal BETWEEN 0 AND 9000 THEN c_acctbal END AS policy,
           CASE WHEN ABS(c_acctbal) < 900 THEN c_acctbal END AS ratio
    FROM customer
    """
)
def null_out_of_range(t):
    balance = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        checks.non_negative(balance).alias("min_amount"),
        checks.below(balance, 5000).alias("fee"),
        checks.within(balance, 0, 9000).alias("policy"),
        checks.magnitude_below(balance, 900).alias("ratio"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
    WHERE NOT (l_discount = 0 AND l_tax = 0)
    """
)
def drop_sentinel_rows(t):
    return drop_zero_rows(t.lineitem, ["l_discount", "l_tax"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


@query(
    """
    SELECT p_partkey, CASE WHEN code IS NOT NULL AND ROW_NUMBER() OVER (
               PARTITION BY code ORDER BY p_partkey) = 1 THEN code END AS code
    FROM (SELECT p_partkey, CASE WHEN p_size >= 5 THEN p_name END AS code FROM part)
    """
)
def keep_first_code(t):
    coded = t.part.select("p_partkey", F.when(F.col("p_size") >= 5, F.col("p_name")).alias("code"))
    return first_code(coded, "code", "p_partkey")


@query(
    """
    SELECT p_partkey,
           CASE WHEN p_partkey = 9 OR ROW_NUMBER() OVER (PARTITION BY label ORDER BY p_partkey) = 1
                THEN label ELSE label || ' (' || p_partkey || ')' END AS p_name
    FROM (SELECT p_partkey, CASE p_partkey WHEN 9 THEN 'large gear' ELSE p_name END AS label
          FROM part)
    """
)
def disambiguate_names(t):
    named = t.part.select("p_partkey", "p_name")
    return distinct_names(named, "p_partkey", "p_name", {9: "large gear"})


@query(
    """
    SELECT c_custkey, LEFT(c_name || ' / ' || c_mktsegment, 24) AS contact FROM customer
    """
)
def truncate_width(t):
    contact = F.concat("c_name", F.lit(" / "), "c_mktsegment")
    return t.customer.select("c_custkey", text.fit_width(contact, 24).alias("contact"))


@query(
    """
    SELECT event_id, CAST(JSON_EXTRACT_STRING(props, '$.k') AS INTEGER) AS k FROM events
    """
)
def json_field(t):
    parsed = F.from_json("props", "k int")
    return t.events.select("event_id", parsed["k"].alias("k"))
