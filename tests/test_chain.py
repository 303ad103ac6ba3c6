"""The whole chain over rows that are many and whose files are small."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from dimflow.operators import dedup, keys, series
from dimflow.session import cut_lineage, fits_broadcast, lookup, shuffle_long
from workload.chain import whole_chain

FUNDS = 700


@pytest.fixture()
def few_fit(spark):
    """A threshold that 128 rows pass, while the files of thousands stay below it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "32k",
        "spark.sql.maxMetadataStringLength": "2000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def broadcast_parts(text: str) -> list[str]:
    """The part of a plan below each broadcast."""
    lines, found = text.splitlines(), []
    for i, line in enumerate(lines):
        at = line.find("BroadcastExchange")
        if at >= 0:
            below = lines[i + 1 :]
            end = next((n for n, x in enumerate(below) if len(re.match(r"[ :+*-]*", x)[0]) <= at), len(below))
            found.append("\n".join(below[:end]))
    return found


@pytest.fixture()
def plans(monkeypatch):
    """Plans of all that is written, and with them what is joined."""
    written, write = [], DataFrameWriter.parquet

    def parquet(self, *args, **options):
        written.append(plan(self._df))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return written


def test_tables_of_the_chain_are_not_broadcast_by_the_size_of_their_files(spark, few_fit, plans):
    ids = spark.range(FUNDS)
    day = F.expr(f"timestamp_seconds(86400 * (9000 + id div {FUNDS}))")
    tables = SimpleNamespace(
        spark=spark,
        nation=spark.range(3).selectExpr("cast(id as int) n_nationkey", "'n' || id n_name", "0 n_regionkey"),
        region=spark.range(5).selectExpr("cast(id as int) r_regionkey", "'r' || id r_name"),
        supplier=spark.range(8).selectExpr("id s_suppkey", "'s' || id s_name", "0 s_nationkey"),
        customer=ids.selectExpr("id c_custkey", "'c' || id c_name", "cast(id % 3 as int) c_nationkey"),
        orders=spark.range(2 * FUNDS).select(
            (F.col("id") % FUNDS).alias("o_custkey"), day.alias("o_orderdate"), F.lit(2.5).alias("o_totalprice")
        ),
    )
    counts = {r["table_name"]: r["n_rows"] for r in whole_chain(tables).collect()}
    real = FUNDS - 1  # without fund 0
    for name in ("mutual_fund", "dim_fund", "portfolio_snapshot", "portfolio_holding", "fact_aum_monthly"):
        assert counts[name] == real
    assert counts["nav_record"] == counts["fact_nav_daily"] == 2 * real
    parts = [part for text in plans for part in broadcast_parts(text)]
    assert parts  # dimensions of few rows
    long = "parsed_fund_index|mutual_fund|dim_fund|nav_record|aum_record|portfolio_snapshot|portfolio_holding"
    scans = [x for part in parts for x in part.splitlines() if "FileScan" in x]
    assert [x for x in scans if re.search(rf"/({long})\b", x)] == []


def test_numbered_rows_join_by_how_many_they_are(spark, few_fit):
    rows = cut_lineage(spark.range(3000).selectExpr("id k", "'x' v"))
    long = keys.number_rows(rows, ["k"], "n")
    short = keys.number_rows(rows.filter("k < 50"), ["k"], "n")
    # the other broadcast is of one offset per partition
    assert (plan(long).count("BroadcastHashJoin"), plan(long).count("SortMergeJoin")) == (1, 1)
    assert (plan(short).count("BroadcastHashJoin"), plan(short).count("SortMergeJoin")) == (2, 0)
    assert long.filter("n = k + 1").count() == 3000
    assert short.filter("n = k + 1").count() == 50


def test_one_key_of_many_rows_is_the_side_that_is_looked_up(spark, few_fit):
    rows = cut_lineage(spark.range(3000).selectExpr("id % 2 k", "'x' v"))
    found = keys.number_rows(rows, ["k"], "n")
    assert "BroadcastHashJoin" in plan(found) and "BuildLeft" not in plan(found)
    assert found.filter("n = k + 1").count() == 3000


def test_sides_as_long_as_the_rows_are_merged(spark, few_fit):
    codes = cut_lineage(spark.range(3000).selectExpr("id pos", "'c' || (id div 2) code"))
    kept = dedup.keep_first_code(codes, "code", "pos")
    assert "BroadcastHashJoin" not in plan(kept)
    assert kept.filter("code IS NOT NULL").count() == 1500
    prices = cut_lineage(
        spark.range(2000).selectExpr("id fund_id", "date '2026-01-01' record_date", "1.0D nav_value")
    )
    assert "BroadcastHashJoin" not in plan(series.nav_return(prices))


def test_the_threshold_of_the_session_counts_by_rows(spark, few_fit):
    rows, one = cut_lineage(spark.range(1000)), spark.range(1000)
    assert fits_broadcast(spark, 128) and not fits_broadcast(spark, 129)
    assert "SortMergeJoin" in plan(one.join(shuffle_long(rows, 129), "id"))
    assert "BroadcastHashJoin" in plan(one.join(shuffle_long(rows, 128), "id"))
    assert "BuildRight" in plan(rows.join(lookup(rows.filter("id < 9"), 9), "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert not fits_broadcast(spark, 0)
