"""Change audit and dimension history between two states of the customers."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from dimflow.functions import labels
from dimflow.operators import history
from dimflow.session import empty_table
from workload.cleaning import LABEL_SQL, typed_orders
from workload.merging import EARLY, LATE, NEW_SQL, OLD_SQL, buyer_states
from workload.tables import query

FIRST_DAY, SECOND_DAY = date(1999, 1, 1), date(2001, 9, 1)
EMPTY = (
    "dim_key bigint, o_custkey bigint, tier int, last_order date, valid_from date, "
    "valid_to date, is_current boolean"
)


@query(
    f"""
    SELECT 'buyer' AS table_name, CAST(n.o_custkey AS VARCHAR) AS record_pk,
           CAST(o.tier AS INTEGER) AS old_tier, CAST(n.tier AS INTEGER) AS new_tier,
           CAST(n.last_order AS VARCHAR) AS new_last_order, 'nightly' AS changed_by
    FROM ({OLD_SQL}) o JOIN ({NEW_SQL}) n ON o.o_custkey = n.o_custkey
    WHERE o.tier IS DISTINCT FROM n.tier
    """
)
def change_audit(t):
    """Values are read back from the row images."""
    log = history.change_audit(
        buyer_states(t, EARLY),
        buyer_states(t, LATE),
        ["o_custkey"],
        "buyer",
        datetime(2001, 9, 1),
        "nightly",
        ignore=("last_order", "n_orders"),
    )
    return log.select(
        "table_name",
        "record_pk",
        F.get_json_object("old_values", "$.tier").cast("int").alias("old_tier"),
        F.get_json_object("new_values", "$.tier").cast("int").alias("new_tier"),
        F.get_json_object("new_values", "$.last_order").alias("new_last_order"),
        "changed_by",
    )


VERSIONS_SQL = f"""
    WITH old AS (
        SELECT ROW_NUMBER() OVER (ORDER BY o_custkey) AS dim_key, o_custkey, tier, last_order
        FROM ({OLD_SQL})),
    new AS (SELECT * FROM ({NEW_SQL})),
    changed AS (
        SELECT o_custkey FROM old JOIN new USING (o_custkey)
        WHERE old.tier IS DISTINCT FROM new.tier),
    opened AS (
        SELECT o_custkey, tier, last_order FROM new
        WHERE o_custkey IN (SELECT o_custkey FROM changed)
           OR o_custkey NOT IN (SELECT o_custkey FROM old))
    SELECT dim_key, o_custkey, tier, last_order, DATE '1999-01-01' AS valid_from,
           CASE WHEN o_custkey IN (SELECT o_custkey FROM changed) THEN DATE '2001-09-01' END
             AS valid_to,
           o_custkey NOT IN (SELECT o_custkey FROM changed) AS is_current
    FROM old
    UNION ALL
    SELECT ROW_NUMBER() OVER (ORDER BY o_custkey) + (SELECT MAX(dim_key) FROM old), o_custkey,
           tier, last_order, DATE '2001-09-01', CAST(NULL AS DATE), TRUE
    FROM opened
"""


@query(VERSIONS_SQL)
def scd2_merge(t):
    dim = empty_table(t.spark, EMPTY)
    for where, day in ((EARLY, FIRST_DAY), (LATE, SECOND_DAY)):
        state = buyer_states(t, where)
        dim = history.scd2_merge(
            dim, state, ["o_custkey"], ["tier"], ["last_order"], day, "dim_key"
        )
    return dim


@query(f"SELECT * FROM ({VERSIONS_SQL}) WHERE is_current")
def scd2_current(t):
    return history.current_versions(scd2_merge(t))


@query(
    f"""
    WITH typed AS (SELECT o_orderdate, label, fund_type AS fund_type_code FROM ({LABEL_SQL})),
    old AS (
        SELECT ROW_NUMBER() OVER (ORDER BY label, fund_type_code) AS category_id, label,
               fund_type_code
        FROM (SELECT DISTINCT label, fund_type_code FROM typed
              WHERE o_orderdate < DATE '1995-01-05'))
    SELECT * FROM old
    UNION ALL
    SELECT ROW_NUMBER() OVER (ORDER BY label, fund_type_code)
             + (SELECT COALESCE(MAX(category_id), 0) FROM old), label, fund_type_code
    FROM (SELECT DISTINCT label, fund_type_code FROM typed
          ANTI JOIN old USING (label, fund_type_code))
    """
)
def scd1_dimension(t):
    """Labels of the first days, then those of all days."""
    label = labels.conservative_label(F.col("fund_type"), F.col("is_index"), F.col("is_etf"))
    rows = typed_orders(t).select(
        "o_orderdate", label.alias("label"), F.col("fund_type").cast("int").alias("fund_type_code")
    )
    dim = empty_table(t.spark, "category_id bigint, label string, fund_type_code int")
    for batch in (rows.filter("o_orderdate < '1995-01-05'"), rows):
        dim = history.scd1_insert(dim, batch, ["label", "fund_type_code"], "category_id")
    return dim
