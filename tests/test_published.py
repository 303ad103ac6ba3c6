"""Slices, deletes, streams and the landing log of the published tables."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimflow.contracts import CONTRACTS
from dimflow.operators.cascade import Link, sweep
from dimflow.operators.rules import Rules, broken_rules
from dimflow.plans.delete import RestrictedDelete, delete_rows
from dimflow.plans.load import merge_table
from dimflow.plans.mart import version_dimension
from dimflow.sources import attempts
from dimflow.sources import documents as docs
from dimflow.sources.published import Published
from dimflow.streaming.loading import load_batch, load_stream

AT = datetime(2026, 7, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def frame(spark, name, rows):
    schema = CONTRACTS[name].schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def put(published, name, rows, batch="a"):
    published.replace(name, frame(published.spark, name, rows), batch)


def performance(spark, *rows):
    named = [(f, 1, str(d), v) for f, d, v in rows]
    return spark.createDataFrame(named, "fund_id int, period_code int, as_of_date string, return_pct double")


def table(published, name, *columns):
    return sorted(tuple(r) for r in published.read(name).select(*columns).collect())


def test_one_days_batch_touches_its_month(spark, tmp_path):
    p = Published(spark, str(tmp_path))
    days = [date(2026, m, d) for m in (1, 2, 3) for d in (5, 20)]
    merge_table(p, "fund_performance", performance(spark, *[(1, d, 0.5) for d in days]), "b1", AT, "me")
    p.publish("b1")
    before = dict(p.slices["fund_performance"])
    assert sorted(before) == ["2026-01", "2026-02", "2026-03"]

    p = Published(spark, str(tmp_path))
    read = []
    own = p.read_slices
    p.read_slices = lambda name, slices: read.append(own(name, slices)) or read[-1]
    new = performance(spark, (1, date(2026, 2, 20), 0.75), (2, date(2026, 2, 21), 0.25))
    merge_table(p, "fund_performance", new, "b2", AT, "me")
    p.publish("b2")
    folders = {f.split("_slice=")[1].split("/")[0] for f in read[0].inputFiles()}
    assert folders == {"2026-02"}
    after = Published(spark, str(tmp_path)).slices["fund_performance"]
    assert {m for m in after if after[m][0] != before[m][0]} == {"2026-02"}
    assert after["2026-02"][1] == 3 and p.counts["fund_performance"] == 7
    got = table(p, "fund_performance", "fund_id", "as_of_date", "return_pct")
    want = [(1, d, Decimal("0.5")) for d in days if d != date(2026, 2, 20)]
    want += [(1, date(2026, 2, 20), Decimal("0.75")), (2, date(2026, 2, 21), Decimal("0.25"))]
    assert got == sorted(want)


def test_children_of_untouched_parents_stay(spark, tmp_path):
    p = Published(spark, str(tmp_path))
    staff = "manager_id int, name string, title string"

    def names(*rows):
        return spark.createDataFrame([(m, n, "t") for m, n in rows], staff)

    merge_table(p, "manager_personnel", names((1, "a"), (2, "b"), (2, "c"), (5000, "d")), "b1", AT, "me")
    p.publish("b1")
    far = p.slices["manager_personnel"]["5"]
    merge_table(p, "manager_personnel", names((2, "x")), "b2", AT, "me")
    p.publish("b2")
    assert table(p, "manager_personnel", "personnel_id", "manager_id", "name") == [
        (1, 1, "a"), (4, 5000, "d"), (5, 2, "x"),
    ]
    assert p.slices["manager_personnel"]["5"] == far
    merge_table(p, "manager_personnel", names(), "b3", AT, "me")
    assert len(table(p, "manager_personnel", "name")) == 3


def test_a_table_written_whole_is_sliced_once(spark, tmp_path):
    p = Published(spark, str(tmp_path))
    merge_table(p, "fund_performance", performance(spark, (1, date(2026, 1, 5), 0.5)), "b1", AT, "me")
    whole = str(tmp_path / "whole")
    p.read("fund_performance").write.parquet(whole)
    p.folders["fund_performance"] = [whole]  # as a list without slices has it
    p.slices = {}
    merge_table(p, "fund_performance", performance(spark, (1, date(2026, 2, 5), 0.25)), "b2", AT, "me")
    assert sorted(p.slices["fund_performance"]) == ["2026-01", "2026-02"]
    assert whole not in p.folders["fund_performance"] and p.counts["fund_performance"] == 2
    assert p.compact("fund_performance", "b3") == 2
    assert len(table(p, "fund_performance", "fund_id")) == 2


def test_closed_versions_are_never_written_again(spark, tmp_path):
    p = Published(spark, str(tmp_path))
    seen = []
    for n, names in enumerate([{1: "a", 2: "b"}, {1: "a2", 2: "b"}, {1: "a3", 3: "c"}, {1: "a3"}], 1):
        rows = [{"manager_id": k, "name": v, "ojk_code": "x", "is_active": True} for k, v in names.items()]
        source = frame(spark, "investment_manager", rows)
        version_dimension(p, "dim_manager", source, ["name", "ojk_code", "is_active"], [], date(2026, 1, n), f"b{n}")
        p.publish(f"b{n}")
        seen.append(list(p.folders["dim_manager"]))
    closed = [[f for f in folders if "-closed" in f] for folders in seen]
    assert [len(c) for c in closed] == [0, 1, 2, 2] and closed[2][:1] == closed[1]
    assert seen[3] == seen[2]  # nothing has changed, nothing is written
    columns = ("dim_manager_key", "manager_id", "name", "valid_from", "valid_to", "is_current")
    day = [date(2026, 1, d) for d in range(6)[1:]]
    assert table(p, "dim_manager", *columns) == [
        (1, 1, "a", day[0], day[1], False), (2, 2, "b", day[0], None, True),
        (3, 1, "a2", day[1], day[2], False), (4, 1, "a3", day[2], None, True), (5, 3, "c", day[2], None, True),
    ]
    assert p.counts["dim_manager"] == 5


def test_history_needs_one_join(spark):
    from dimflow.operators.history import scd2_states

    dim = frame(spark, "dim_manager", [{"dim_manager_key": 1, "manager_id": 1, "is_current": True}])
    source = dim.select("manager_id", "name", "ojk_code", "is_active")
    states = scd2_states(dim, source, ["manager_id"], ["name"], [], date(2026, 1, 1))
    assert states._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def fill(p):
    funds = [{"fund_id": i, "manager_id": i, "bank_id": 1, "name": f"f{i}"} for i in (1, 2)]
    put(p, "investment_manager", [{"manager_id": i, "name": "m", "ojk_code": str(i)} for i in (1, 2, 3)])
    put(p, "manager_personnel", [{"personnel_id": i, "manager_id": 3, "name": "n"} for i in (1, 2)])
    put(p, "custodian_bank", [{"bank_id": 1, "name": "b"}])
    put(p, "mutual_fund", funds)
    put(p, "nav_record", [{"fund_id": i % 2 + 1, "record_date": date(2026, 1, i)} for i in range(1, 8)])
    put(p, "portfolio_snapshot", [{"snapshot_id": i, "fund_id": i, "date_based": date(2026, 1, 1)} for i in (1, 2)])
    put(p, "asset_category", [{"category_id": 1, "name": "c"}])
    lines = [{"allocation_id": i, "snapshot_id": i % 2 + 1, "category_id": 1, "value_pct": 1} for i in range(5)]
    put(p, "portfolio_allocation", [{**r, "value_pct": Decimal(1)} for r in lines])
    put(p, "fund_performance", [{"fund_id": i, "period_code": 1, "as_of_date": date(2026, i, 1)} for i in (1, 2)])


def test_delete_sweeps_three_levels(spark, tmp_path):
    p = Published(spark, str(tmp_path))
    fill(p)
    kept = p.slices["fund_performance"]["2026-02"]
    keys = spark.createDataFrame([(1,), (77,)], "fund_id int")
    assert delete_rows(p, "mutual_fund", keys, "b") == {
        "mutual_fund": 1, "nav_record": 3, "portfolio_snapshot": 1, "portfolio_allocation": 3,
        "fund_performance": 1,
    }
    assert table(p, "portfolio_allocation", "snapshot_id") == [(2,)] * 2
    assert table(p, "nav_record", "fund_id") == [(2,)] * 4
    assert p.slices["fund_performance"] == {"2026-02": kept}
    assert p.counts["nav_record"] == 4 and p.counts["fund_performance"] == 1
    assert delete_rows(p, "mutual_fund", keys, "c") == {}


def test_delete_is_refused_while_a_row_is_needed(spark, tmp_path):
    p = Published(spark, str(tmp_path))
    fill(p)
    counts = dict(p.counts)
    with pytest.raises(RestrictedDelete, match="1 rows of mutual_fund by manager_id"):
        delete_rows(p, "investment_manager", spark.createDataFrame([(2,), (3,)], "manager_id int"), "b")
    assert p.counts == counts and len(table(p, "manager_personnel", "manager_id")) == 2
    gone = delete_rows(p, "investment_manager", spark.createDataFrame([(3,)], "manager_id int"), "b")
    assert gone == {"investment_manager": 1, "manager_personnel": 2}


def test_null_keys_and_two_parents(spark):
    tables = {
        "a": spark.createDataFrame([(1,), (2,), (None,)], "a int"),
        "b": spark.createDataFrame([(1,), (2,)], "b int"),
        "c": spark.createDataFrame([(1, 1, None), (2, 2, 1), (3, None, 2), (4, 2, 2)], "c int, a int, b int"),
    }
    links = [Link("b", "b", "a", "a"), Link("c", "a", "a", "a"), Link("c", "b", "b", "b")]
    marked = sweep(tables, links, "a", spark.createDataFrame([(1,), (None,)], "a int"))
    assert sorted(r["c"] for r in marked["c"].filter("_doomed").collect()) == [1, 2]
    assert marked["a"].filter("_doomed").count() == 1


def test_each_table_is_scanned_once(spark):
    folder = "/root/testdata/sf0.001"
    tables = {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in ("customer", "orders", "lineitem")}
    rules = {
        "customer": Rules(unique={"u": (["c_name"], None), "v": (["c_phone"], None)}),
        "orders": Rules({"p": F.col("o_totalprice") > 0}, {}, {"o_custkey": ("customer", "c_custkey")}),
        "lineitem": Rules({}, {}, {"l_orderkey": ("orders", "o_orderkey")}),
    }
    rules["customer"].unique.pop("v")
    found = broken_rules(tables, rules)
    text = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("FileScan parquet") == 3
    assert text.count("Exchange hashpartitioning") == 2  # by value, then by rule


def landed(spark, rows):
    return spark.createDataFrame([(f"{k}.json", k, body) for k, body in rows], docs.LANDED)


def amounts(manager, *points):
    rows = ", ".join(f'{{"Date": "{d}T00:00:00", "Aum": {v}, "TotalUnit": 1}}' for d, v in points)
    return str(manager), f"[{rows}]"


def test_a_replayed_stream_batch_adds_nothing(spark, tmp_path):
    options = {
        "stream": "s", "source": "manager_aum", "work": f"{tmp_path}/w", "root": f"{tmp_path}/r", "batch_ts": AT,
    }
    folder, progress = f"{tmp_path}/landed", f"{tmp_path}/progress"

    def rows():
        return table(Published(spark, f"{tmp_path}/r"), "manager_aum_record", "manager_id", "aum_value")

    landed(spark, [amounts(1, ("2026-01-01", 5))]).write.mode("append").parquet(folder)
    load_stream(docs.landed_stream(spark, folder), progress, **options)
    load_stream(docs.landed_stream(spark, folder), progress, **options)  # nothing new
    second = landed(spark, [amounts(1, ("2026-01-01", 9), ("2026-02-01", 6)), amounts(2, ("2026-01-01", 7))])
    second.write.mode("append").parquet(folder)
    load_stream(docs.landed_stream(spark, folder), progress, **options)
    assert rows() == [(1, 5), (1, 6), (2, 7)]
    seq = Published(spark, f"{tmp_path}/r").seq
    assert seq == 2 and not load_batch(second, 1, **options) and not load_batch(second, 0, **options)
    assert Published(spark, f"{tmp_path}/r").seq == seq and len(rows()) == 3


def test_a_batch_that_fails_leaves_no_trace(spark, tmp_path, monkeypatch):
    options = {
        "stream": "s", "source": "quarterly", "work": f"{tmp_path}/w", "root": f"{tmp_path}/r", "batch_ts": AT,
    }
    p = Published(spark, f"{tmp_path}/r")
    put(p, "mutual_fund", [{"fund_id": 7}])
    p.publish("masters")
    body = '[{"Year": 2025, "Quarter": 1, "Return": 0.5}]'
    documents = landed(spark, [("7_2025", body)])
    own = Published.publish

    def lost(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(Published, "publish", lost)
    with pytest.raises(RuntimeError):
        load_batch(documents, 0, **options)
    monkeypatch.setattr(Published, "publish", own)
    assert Published(spark, f"{tmp_path}/r").streams == {}
    assert load_batch(documents, 0, **options)
    assert Published(spark, f"{tmp_path}/r").streams == {"s": 0}


def test_landing_log(spark, tmp_path):
    log = str(tmp_path / "log")

    def keys(*names):
        return spark.createDataFrame([("x", n) for n in names], "source string, file_key string")

    def bodies(**found):
        return spark.createDataFrame([("x", k, v) for k, v in found.items()], "source string, file_key string, body string")

    first = bodies(a="[1]", b="[]", c='{"_error": 1}', d="null", e="[")
    attempts.record_run(keys("a", "b", "c", "d", "e", "f"), first, log, "r1", datetime(2026, 1, 1))
    second = bodies(c="[2]", g='{"a": 1}')
    attempts.record_run(keys("a", "c", "f", "g"), second, log, "r2", datetime(2026, 1, 2), retry=True)
    attempts.record_run(keys("a", "c"), second, log, "r2", datetime(2026, 1, 2), retry=True)
    attempts.record_run(keys("a", "h"), bodies(a="[]"), log, "r3", datetime(2026, 1, 3), force=True)
    made = attempts.read_attempts(spark, log)
    told = {(r["run"], r["file_key"]): r["outcome"] for r in made.collect()}
    assert told == {
        ("r1", "a"): "fetched", ("r1", "b"): "empty", ("r1", "c"): "failed", ("r1", "d"): "empty",
        ("r1", "e"): "failed", ("r1", "f"): "missing", ("r2", "a"): "skipped", ("r2", "c"): "fetched",
        ("r2", "f"): "missing", ("r2", "g"): "fetched", ("r3", "a"): "empty", ("r3", "h"): "missing",
    }
    assert made.count() == len(told)
    newest = {r["file_key"]: r["outcome"] for r in attempts.newest_states(made).collect()}
    assert newest == {"a": "empty", "b": "empty", "c": "fetched", "d": "empty", "e": "failed", "f": "missing",
                      "g": "fetched", "h": "missing"}
    assert attempts.to_attempt(keys("a", "e", "z"), made).collect() == [("x", "z")]


def test_numbers_are_stored_with_their_keys_alone(spark, monkeypatch):
    from dimflow.operators import keys

    stored = []
    monkeypatch.setattr(keys, "cut_lineage", lambda df: stored.append(df.columns) or df)
    rows = spark.createDataFrame([("b", 1, "x"), ("a", 2, "y"), (None, 3, "z"), ("b", 4, "w")], "k string, v int, t string")
    found = keys.number_rows(rows, ["k"], "n").collect()
    assert sorted((r["n"], r["v"], r["t"]) for r in found) == [(1, 3, "z"), (2, 2, "y"), (3, 1, "x"), (3, 4, "w")]
    assert stored == [["k", "_at"]]
    alone = keys.number_rows(rows.select("k"), ["k"], "n").collect()
    assert sorted(r["n"] for r in alone) == [1, 2, 3, 4]  # equal rows have numbers of their own


def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch):
    from dimflow.plans import refresh as plan_of

    from raw_fixture import write_raw

    raw = write_raw(tmp_path / "raw")
    ran = []
    for name in ("transform", "load", "load_mart"):
        own = getattr(plan_of, name)
        monkeypatch.setattr(plan_of, name, lambda *a, _f=own, _n=name, **k: ran.append(_n) or _f(*a, **k))
    args = (spark, str(raw), str(tmp_path / "work"), str(tmp_path / "root"), datetime(2026, 7, 1, 8))

    def fail(*_, **__):
        ran.append("stopped")
        raise RuntimeError("lost")

    with monkeypatch.context() as stop:
        stop.setattr(plan_of, "load_mart", fail)
        with pytest.raises(RuntimeError):
            plan_of.refresh(*args, rating_field="ProviderRating")
    assert Published(spark, str(tmp_path / "root")).folders == {}
    done = plan_of.refresh(*args, rating_field="ProviderRating")
    assert ran == ["transform", "load", "stopped", "load_mart"]
    assert done.counts["fact_nav_daily"] == done.counts["nav_record"] == 4
    assert Published(spark, str(tmp_path / "root")).counts == done.counts
    again = plan_of.refresh(*args, rating_field="ProviderRating")  # published: it runs anew
    assert ran[4:] == ["transform", "load", "load_mart"] and again.counts == done.counts


def test_moments_of_batches_merge(spark):
    from dimflow.plans import reports

    rows = [(20240100 + i % 28 + 1, 1 + i % 5 * 40_000, 1 + i % 2, 0.01 * ((i * 7) % 11 - 4)) for i in range(60)]
    rows += [(20240201, 9, 3, 0.5), (20240202, 8, 3, None), (20240203, 7, 4, None), (20230101, 6, 1, 9.0), (20240231, 6, 1, 9.0)]
    facts = spark.createDataFrame(rows, "date_id int, fund_id int, category_id int, daily_return double")
    categories = spark.createDataFrame([(i, f"c{i}") for i in range(1, 5)], "category_id int, label string")
    days = spark.createDataFrame([(d, d // 10000) for d in {r[0] for r in rows} - {20240231}], "date_id int, year int")
    parts = [facts.filter(F.col("fund_id") % 3 == k) for k in range(3)]
    states = [reports.monthly_moments(p, categories, days) for p in parts]
    merged = reports.volatility_of_moments(states[0].unionByName(states[1]).unionByName(states[2]), 2024)
    want = {r["label"]: r for r in reports.category_volatility(facts, categories, days, 2024).collect()}
    got = {r["label"]: r for r in merged.collect()}
    assert set(got) == set(want)
    for label, row in want.items():
        assert got[label]["n_fund"] == row["n_fund"]
        for column in ("ann_volatility", "ann_return"):
            assert got[label][column] == (pytest.approx(row[column]) if row[column] is not None else None)


def test_a_batch_may_write_twice_to_a_table(spark, tmp_path):
    p = Published(spark, str(tmp_path))
    rows = [{"table_name": "a", "record_pk": str(i), "reject_reason": "r", "batch": "b"} for i in range(3)]
    p.append("reject_log", frame(spark, "reject_log", rows[:1]), "b")
    p.append("reject_log", frame(spark, "reject_log", rows[1:]), "b")
    merge_table(p, "fund_performance", performance(spark, (1, date(2026, 1, 5), 0.5)), "b", AT, "me")
    merge_table(p, "fund_performance", performance(spark, (2, date(2026, 1, 6), 0.5)), "b", AT, "me")
    p.publish("b")
    again = Published(spark, str(tmp_path))
    assert table(again, "reject_log", "record_pk") == [("0",), ("1",), ("2",)]
    assert table(again, "fund_performance", "fund_id") == [(1,), (2,)]
    assert again.counts["reject_log"] == 3 and again.counts["fund_performance"] == 2
