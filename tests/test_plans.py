"""Plans: what is pushed down, pruned before a shuffle, and split when hot."""

import pytest
from pyspark.sql import functions as F

from dimflow.operators import dedup, keys, merge, quality, series
from dimflow.plans import reports
from dimflow.sources import documents as docs

ORDERS = "/root/testdata/sf0.001/orders.parquet"


@pytest.fixture(autouse=True)
def long_plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df) -> int:
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture()
def no_broadcast(spark):
    """Shuffled joins with limits small enough for test data to count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture()
def hot(spark):
    """Half of all rows share one key."""
    spread = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    return spark.range(0, 400000, 1, 8).select(spread.alias("k"), F.col("id").alias("v"))


def test_hot_parent_is_split(spark, no_broadcast, hot):
    parents = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") + 1).alias("parent_id"))
    found = keys.resolve_keys(hot, parents, ["k"], "parent_id")
    assert len(found.collect()) == 400000
    assert "skew=true" in plan(found)
    assert plan(found).split("Initial Plan")[0].count("SortMergeJoin") == 1
    assert found.filter("parent_id IS NULL").count() == 0


def test_hot_children_are_split(spark, no_broadcast, hot):
    batch = spark.range(900, 950).select(F.col("id").alias("k"), F.lit(-1).alias("v"))
    kept = merge.replace_children(hot, batch, "k")
    counts = kept.groupBy((F.col("v") < 0).alias("new")).count().collect()
    removed = hot.filter("k BETWEEN 900 AND 949").count()
    assert {r["new"]: r["count"] for r in counts} == {True: 50, False: 400000 - removed}
    rows = merge.replace_children(hot, batch, "k")
    rows.collect()
    assert "skew=true" in plan(rows)


def test_first_per_key_prunes_before_the_shuffle(hot):
    text = plan(dedup.first_per_key(hot, ["k"], [F.col("v")]))
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_latest_return_prunes_before_the_shuffle(hot):
    days = hot.select("k", F.date_add(F.lit("2000-01-01"), F.col("v").cast("int")).alias("d"), "v")
    latest = series.latest_return(days, ["k"], "d", "v")
    assert shuffles(latest) == 1
    assert "WindowGroupLimit" in plan(latest).split("Exchange hashpartitioning")[1]


def test_sums_combine_before_the_shuffle(hot):
    text = plan(merge.sum_duplicates(hot, ["k"], "v"))
    assert "partial_sum" in text.split("Exchange hashpartitioning")[1]


def test_orphans_count_before_they_join(spark, no_broadcast, hot):
    parents = spark.range(10).select(F.col("id").alias("k"))
    text = plan(quality.orphans(hot, ["k"], parents, ["k"]))
    assert text.index("LeftAnti") < text.index("partial_count")


def test_return_window_shares_its_shuffle_with_the_join(spark, no_broadcast):
    days = spark.range(100).select(
        (F.col("id") % 3).alias("fund_id"),
        F.date_add(F.lit("2000-01-01"), F.col("id").cast("int")).alias("record_date"),
        F.col("id").alias("nav_value"),
    )
    text = plan(series.nav_return(days.repartition(4)))
    join = text[text.index("SortMergeJoin"):]
    left = join[: join.index("Window [lag")] if "Window [lag" in join else join
    # Between the join and the window of the long side there is no exchange.
    assert "Exchange" not in left.split("Window [")[0]


def test_range_reaches_the_scan(spark):
    scan = plan(docs.in_range(spark.read.parquet(ORDERS), "o_orderdate", "1996-01-01", "1996-12-31"))
    assert "GreaterThanOrEqual(o_orderdate" in scan and "LessThanOrEqual(o_orderdate" in scan


def test_span_limits_the_stored_side(spark):
    old = spark.read.parquet(ORDERS).select("o_custkey", "o_orderdate")
    new = old.filter("o_orderdate >= '2001-01-01'")
    fresh = merge.absent_rows(
        old, new, ["o_custkey", "o_orderdate"], span=merge.span_of(new, "o_orderdate")
    )
    assert plan(fresh).count("LessThanOrEqual(o_orderdate") == 1


def test_reports_read_only_their_columns(spark):
    orders = spark.read.parquet(ORDERS)
    totals = reports.totals_by_currency(orders, "o_orderstatus", "o_totalprice", [])
    assert "ReadSchema: struct<o_orderstatus:string,o_totalprice:double>" in plan(totals)


def test_documents_are_parsed_once(spark, tmp_path):
    (tmp_path / "1.json").write_text('[{"Date": "2026-01-01", "Value": 1}]')
    parsed = docs.parse_arrays(docs.read_documents(spark, str(tmp_path)), "Date string, Value double")
    # once for the status and once for the elements
    assert plan(parsed).count("from_json") == 2
    assert len(parsed.collect()) == 1


def test_copies_of_a_key_go_before_the_shuffle(spark, no_broadcast, hot):
    known = spark.range(3).select(F.col("id").alias("k"))
    fresh = merge.absent_rows(known, hot, ["k"], [F.col("v")])
    text = plan(fresh)
    assert "WindowGroupLimit" in text.split("Exchange hashpartitioning")[1]
    assert sorted(r["k"] for r in fresh.collect())[:3] == [3, 5, 7]


def test_documents_are_parsed_once(spark):
    """Whatever is read of the elements, the plan has one parser."""
    found = spark.createDataFrame([("1.json", "1", '[{"Id": 1}]')], docs.LANDED)
    for parse in (docs.parse_arrays, docs.parse_objects):
        rows = parse(found, "Id int, x array<struct<y:int>>").filter("Id > 0")
        rows = rows.select("file_key", "Id", F.explode_outer("x").alias("x")).filter("x IS NULL OR x.y > 0")
        assert plan(rows).split("Initial Plan")[0].count("from_json(") == 1
