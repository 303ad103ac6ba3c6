"""Operators on small tables, with brute force where order or skew matters."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimflow.operators import dedup, history, keys, merge, quality, series, shred
from dimflow.session import cut_lineage, empty_table
from dimflow.sources import documents as docs


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert rows(dedup.first_per_key(df, ["k"], [F.col("o")]), "k", "v") == [("a", "x"), ("b", "z")]
    assert rows(dedup.last_per_key(df, ["k"], ["o"]), "k", "v") == [("a", "y"), ("b", "z")]
    assert rows(dedup.latest_per_key(df, ["k"], "o", ["v"])) == [("a", 2, "y"), ("b", 5, "z")]


def test_keep_first_code(spark):
    df = spark.createDataFrame([(1, "X"), (2, "X"), (3, None), (4, "Y"), (5, None)], "pos int, code string")
    assert sorted(r["pos"] for r in dedup.keep_first_code(df, "code", "pos").collect() if r["code"]) == [1, 4]


def test_keep_first_code_where_all_share_a_position(spark):
    schema = "pos int, fund_id int, code string"
    df = spark.createDataFrame([(0, 3, "X"), (0, 2, "X"), (0, 4, "Y"), (0, 1, None), (0, 5, None)], schema)
    kept = dedup.keep_first_code(df, "code", "pos", "fund_id").select("fund_id", "code")
    assert rows(kept) == [(1, None), (2, "X"), (3, None), (4, "Y"), (5, None)]
    twice = dedup.keep_first_code(df, "code", "pos").select("fund_id", "code")
    assert rows(twice) == [(1, None), (2, "X"), (3, "X"), (4, "Y"), (5, None)]


def test_distinct_names_like_a_loop(spark):
    generator = random.Random(1)
    for _ in range(4):
        choices = ["a", "b", "a (3)", "b (4)", "real", "a (3) (5)", "a (3) (5) (6)"]
        names = [(i, generator.choice(choices)) for i in range(12)]
        seen, want = set(), []
        for i, name in names:
            if i == 7:
                name = "real"
            else:
                while name in seen:
                    name = f"{name} ({i})"
            seen.add(name)
            want.append((i, name))
        df = spark.createDataFrame(names, "id int, name string")
        assert rows(dedup.distinct_names(df, "id", "name", {7: "real"})) == want


def test_number_rows_is_dense_and_sorted(spark):
    values = [(f"k{i:05d}",) for i in range(2000)]
    random.Random(2).shuffle(values)
    df = spark.createDataFrame(values, "k string").repartition(7)
    numbered = {r["k"]: r["id"] for r in keys.number_rows(df, ["k"], "id").collect()}
    assert numbered == {f"k{i:05d}": i + 1 for i in range(2000)}


def test_number_absent_goes_on(spark):
    known = spark.createDataFrame([("b", 4), ("d", 9)], "k string, id bigint")
    fresh = keys.number_absent(known, spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), ["k"], "id")
    assert rows(fresh, "k", "id") == [("a", 10), ("c", 11)]
    none = keys.number_absent(known, known.select("k"), ["k"], "id")
    assert rows(none, "k", "id") == []


def test_resolve_keys(spark):
    children = spark.createDataFrame([(1, "x"), (999, "y")], "ref int, v string")
    key_map = spark.createDataFrame([(1, 42)], "ref int, id int")
    found = keys.resolve_keys(children, key_map, ["ref"], "id")
    assert {(r["v"], r["id"]) for r in found.collect()} == {("x", 42), ("y", None)}


def test_upsert_keeps_unlisted_columns(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, kept int")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(merge.upsert(old, new, ["k"])) == [(1, "a", 10), (2, "B", 20), (3, "C", None)]


def test_insert_if_absent_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "z"), (2, "b"), (2, "c"), (None, "d")], "k int, v string")
    order = [F.col("v")]
    once = merge.insert_if_absent(old, new, ["k"], order)
    assert rows(once) == [(1, "a"), (2, "b")]
    assert rows(merge.insert_if_absent(once, new, ["k"], order)) == rows(once)
    span = merge.span_of(new, "k")
    assert rows(merge.insert_if_absent(old, new, ["k"], order, span)) == rows(once)


def test_replace_children(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "p int, v string")
    new = spark.createDataFrame([(1, "x"), (3, "y")], "p int, v string")
    assert rows(merge.replace_children(old, new, "p")) == [(1, "x"), (2, "c"), (3, "y")]
    assert rows(merge.replace_children(old, new.limit(0), "p")) == rows(old)


def test_sum_duplicates(spark):
    lines = [(1717, "2026-06-30", 0, Decimal("69.9"), "first"), (1717, "2026-06-30", 0, Decimal("21.8"), "second"),
             (1, "2026-01-01", 1, Decimal("50"), "only")]
    df = spark.createDataFrame(lines, "f int, d string, c int, value decimal(18,4), note string")
    merged = merge.sum_duplicates(df, ["f", "d", "c"], "value", ["note"])
    assert rows(merged, "f", "value", "note") == [(1, Decimal("50.0000"), "only"), (1717, Decimal("91.7000"), "first")]


def test_zero_sentinels(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 0, 3), (3, 0, None)], "id int, a int, b int")
    assert rows(quality.drop_zero_rows(df, ["a", "b"]), "id") == [(2,), (3,)]


def test_violations_and_duplicates(spark):
    df = spark.createDataFrame([(1, -1.0, "abc"), (2, None, "ab"), (3, 1000.0, None)], "id int, v double, s string")
    checks = {"sign": F.col("v") >= 0, "width": quality.fits_width(F.col("s"), 2), "fit": quality.fits_decimal(F.col("v"), 5, 2)}
    assert rows(quality.violations(df, ["id"], checks)) == [(1, "sign"), (1, "width"), (3, "fit")]
    pairs = spark.createDataFrame([("x", 1), ("x", 2), (None, 3), (None, 4)], "k string, v int")
    assert rows(quality.duplicate_keys(pairs, ["k"])) == [("x", 2)]


def test_orphans_exempt_null_keys(spark):
    children = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    parents = spark.createDataFrame([(2,)], "pk int")
    assert rows(quality.orphans(children, ["fk"], parents, ["pk"])) == [(1, 2)]


def test_sum_anomalies_count_empty_portfolios(spark):
    snapshots = spark.createDataFrame([(1,), (2,), (3,)], "s int")
    allocations = spark.createDataFrame([(1, 60.0), (1, 40.0), (2, 87.0)], "s int, v double")
    holdings = spark.createDataFrame([(1, 101.0)], "s int, v double")
    found = quality.sum_anomalies(snapshots, allocations, holdings, ["s"], "v")
    assert rows(found, "s", "allocation_off", "holding_over") == [(1, False, True), (2, True, False), (3, True, False)]
    counts = quality.sum_checkpoint(allocations, holdings, ["s"], "v").first()
    assert (counts["allocation_snapshots"], counts["allocation_off"], counts["holding_max"]) == (2, 1, 101.0)


def test_fingerprint_ignores_row_order(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(100)], "a int, b string")
    columns = [F.col("a"), F.col("b")]
    one = quality.fingerprint(df, columns).first()
    assert one == quality.fingerprint(df.repartition(5).orderBy(F.desc("a")), columns).first()
    assert one != quality.fingerprint(df.withColumn("b", F.lit("x")), columns).first()


def test_previous_value_over_gaps_and_a_hot_owner(spark):
    """One owner has far more rows than the others; slots may be empty."""
    generator, data = random.Random(3), {}
    for owner, n in ((1, 900), (2, 40), (3, 1)):
        days = generator.sample(range(4000), n)
        data[owner] = {date(2015, 1, 1) + timedelta(d): generator.choice([None, 0, 1, 2.5, 7]) for d in days}
    df = spark.createDataFrame(
        [(o, d, None if v is None else float(v)) for o, s in data.items() for d, v in s.items()],
        "fund_id int, record_date date, nav_value double",
    )
    want = []
    for owner, points in data.items():
        before = None
        for d in sorted(points):
            value, previous = points[d], before
            change = (value - previous) / previous if value is not None and previous else None
            want.append((owner, d, previous, change))
            before = value
    for slot in ("month", "year"):
        got = series.period_return(df, ["fund_id"], "record_date", "nav_value", "prev", slot=slot)
        found = {(r[0], r[1]): (r["prev"], r["daily_return"]) for r in got.collect()}
        assert len(found) == len(want)
        for owner, d, previous, change in want:
            assert found[owner, d] == (previous, pytest.approx(change) if change is not None else None)
    whole = series.nav_return(df)
    for some in ("day(record_date) = 3", "fund_id = 2", "fund_id = 3", "record_date >= '2025-06-01'", "false"):
        new = df.filter(some).select("fund_id", "record_date")
        part = series.nav_return(df, new)
        wanted = whole.join(new, ["fund_id", "record_date"], "left_semi")
        assert sorted(map(str, part.collect())) == sorted(map(str, wanted.collect())), some
    newest = {r["fund_id"]: r for r in series.latest_return(df, ["fund_id"], "record_date", "nav_value").collect()}
    for owner, points in data.items():
        owner_rows = [w for w in want if w[0] == owner]
        assert newest[owner]["record_date"] == owner_rows[-1][1]
        last = owner_rows[-1][3]
        assert newest[owner]["daily_return"] == (None if last is None else pytest.approx(last))


STATE = "id int, name string, fee int, opened date, scraped_at timestamp"
DIM = "k bigint, id int, name string, fee int, opened date, valid_from date, valid_to date, is_current boolean"


def state(spark, data):
    return spark.createDataFrame([(i, n, f, date(2020, 1, o), datetime(2026, 1, 1, o)) for i, n, f, o in data], STATE)


def test_change_audit(spark):
    before = state(spark, [(1, "a", 1, 1), (2, "b", None, 1), (3, "c", 3, 1)])
    after = state(spark, [(1, "a", 1, 2), (2, "b", 5, 1), (4, "d", 4, 1)])
    log = history.change_audit(before, after, ["id"], "t", datetime(2026, 7, 1), "me", ("scraped_at", "opened"))
    (row,) = log.collect()
    assert (row["table_name"], row["record_pk"], row["changed_by"]) == ("t", "2", "me")
    assert '"fee":null' in row["old_values"] and '"fee":5' in row["new_values"]
    assert "scraped_at" in row["new_values"]
    assert not history.change_audit(before, before, ["id"], "t", datetime(2026, 7, 1), "me").collect()


def brute_scd2(dim, src, today):
    out, standing = [], set()
    for version in dim:
        version = dict(version)
        fresh = src.get(version["id"])
        if version["is_current"]:
            if fresh and fresh[:2] != (version["name"], version["fee"]):
                version.update(valid_to=today, is_current=False)
            else:
                standing.add(version["id"])
        out.append(version)
    number = max([v["k"] for v in out], default=0)
    for key in sorted(set(src) - standing):
        number += 1
        name, fee, opened = src[key]
        out.append({"k": number, "id": key, "name": name, "fee": fee, "opened": opened,
                    "valid_from": today, "valid_to": None, "is_current": True})
    return out


def test_scd2_against_brute_force(spark):
    generator = random.Random(5)
    dim_df, dim = empty_table(spark, DIM), []
    for step in range(4):
        today = date(2026, 1, 1) + timedelta(step // 2)  # two batches on one day
        src = {
            i: (generator.choice("ab"), generator.choice([None, 1, 2]), date(2020, 1, generator.randint(1, 28)))
            for i in generator.sample(range(20), 12)
        }
        src_df = spark.createDataFrame([(i, *v) for i, v in src.items()], "id int, name string, fee int, opened date")
        merged = history.scd2_merge(dim_df, src_df, ["id"], ["name", "fee"], ["opened"], today, "k")
        dim = brute_scd2(dim, src, today)
        columns = dim_df.columns
        got = sorted(map(str, (tuple(r[c] for c in columns) for r in merged.collect())))
        assert got == sorted(map(str, (tuple(v[c] for c in columns) for v in dim)))
        dim_df = spark.createDataFrame([tuple(v[c] for c in columns) for v in dim], DIM)
    again = history.scd2_merge(dim_df, src_df, ["id"], ["name", "fee"], ["opened"], date(2027, 1, 1), "k")
    assert again.count() == dim_df.count()
    assert not quality.duplicate_keys(again, ["id"], F.col("is_current")).collect()


def test_scd1_insert(spark):
    dim = empty_table(spark, "id bigint, label string")
    source = spark.createDataFrame([("b",), ("a",), ("b",)], "label string")
    once = history.scd1_insert(dim, source, ["label"], "id")
    assert rows(once, "id", "label") == [(1, "a"), (2, "b")]
    assert rows(history.scd1_insert(once, source, ["label"], "id")) == rows(once)


def test_units_of_wide_documents_are_not_broadcast(spark):
    body = (
        '{"AssetUnderManagements": [{"Date": "2026-01-31T00:00:00", "Value": 10.5}, '
        '{"Date": "2026-02-28T00:00:00", "Value": 11.0}], '
        '"TotalUnits": [{"Date": "2026-01-31T00:00:00", "Value": 2.0}, '
        '{"Date": "2026-01-31T00:00:00", "Value": 3.0}]}'
    )
    landed = spark.createDataFrame([("7.json", "7", body), ("8.json", "8", body)], docs.LANDED)
    # stored, as the size of stored documents is known
    parsed = cut_lineage(docs.parse_objects(landed, shred.snapshot_shape("ProviderRating")))
    found = shred.aum(parsed)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    january, february = date(2026, 1, 31), date(2026, 2, 28)
    assert sorted(found.select("fund_id", "record_date", "aum_value", "total_units").collect()) == [
        (7, january, 10, 3.0), (7, february, 11, None), (8, january, 10, 3.0), (8, february, 11, None)
    ]
