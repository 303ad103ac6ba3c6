"""The whole chain on a small landing folder, run again and again."""

import shutil
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dimflow.operators.series import batch_coverage, benchmark_return
from dimflow.plans import reports
from dimflow.plans.load import label_report, merge_table, portfolio_report
from dimflow.plans.refresh import counts, integrity_report, refresh
from dimflow.plans.transform import (
    FOLDERS,
    Clean,
    landing_report,
    pending_documents,
    pending_quarters,
    tables_of,
)
from dimflow.sources import documents as docs
from dimflow.sources.published import Published
from dimflow.streaming.landing import land_new
from raw_fixture import write_raw


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("chain")
    raw = write_raw(base / "raw")
    published = refresh(spark, str(raw), str(base / "work"), str(base / "root"), datetime(2026, 7, 1, 8), rating_field="ProviderRating")
    return base, published


def table(published, name, *columns):
    df = published.read(name)
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


def test_document_status(spark, first):
    base, _ = first
    (base / "raw" / "snapshot" / "note.txt").write_text("no document")
    found = docs.landing_status(docs.read_documents(spark, str(base / "raw" / "snapshot")), F.lit("snapshot"))
    assert {r["status"]: r["n_documents"] for r in found.collect()} == {
        "data": 2, "null": 1, "failed": 1, "unreadable": 1,
    }
    assert docs.read_documents(spark, str(base / "nowhere")).count() == 0


def test_masters(first):
    _, p = first
    managers = table(p, "investment_manager", "manager_id", "mi_permit_num", "telephone", "capital",
                     "paid_in_capital", "is_active")
    assert managers == [(1, None, "021", 1000000, 5000, True), (2, None, None, None, None, False)]
    assert table(p, "manager_personnel", "personnel_id", "name") == [(1, "A"), (2, "B")]
    assert len(table(p, "custodian_bank", "telephone")[0][0]) == 50
    assert table(p, "manager_aum_record", "aum_value") == [(Decimal("10.50"),), (Decimal("11.00"),)]
    assert table(p, "asset_category") == [(0, "Saham"), (7, "Pasar Uang"), (9, "Real Estate")]


def test_funds(first):
    _, p = first
    got = table(p, "mutual_fund", "fund_id", "class_group_id", "class_name", "isin_code", "conservative_label")
    assert got == [
        (101, 5, "Kelas A", "X1", "Saham"),
        (102, 5, "Kelas B", None, "Saham"),
        (103, None, None, None, "Exchange Traded Fund"),
        (104, None, None, None, "Terproteksi"),
    ]
    details = table(p, "mutual_fund", "fund_id", "min_subscription", "min_next_subscription",
                    "sub_fee_max_pct", "red_fee_max_pct", "policy_bond_pct", "policy_equity_pct")[0]
    assert details == (101, 100000, None, Decimal("0.3000"), None, Decimal("2.00"), None)
    assert table(p, "fund_class") == [(5, "Alpha")]


def test_series_and_lines(first):
    _, p = first
    assert [r[2] for r in table(p, "nav_record", "fund_id", "record_date", "nav_value")] == [100, 110, 121, 50]
    assert table(p, "aum_record", "aum_value", "total_units") == [(1210, Decimal("10.0000"))]
    assert table(p, "portfolio_allocation", "category_id", "value_pct") == [
        (0, Decimal("91.7000")), (7, Decimal("8.3000")),
    ]
    assert table(p, "portfolio_holding", "security_id", "value_pct") == [
        (1, Decimal("7.0000")), (2, Decimal("3.0000")),
    ]
    assert table(p, "fund_performance", "as_of_date", "treynor_ratio")[0][1] is None
    assert len(table(p, "fund_ranking")) == 1
    assert table(p, "benchmark") == [(79, "IX again"), (93, "LQ")]
    assert table(p, "benchmark_data_point", "value") == [(Decimal("7000.5"),)]
    assert table(p, "fund_benchmark") == [(101, 79, True), (101, 93, False)]
    assert table(p, "fund_sales_company") == [(101, 7, Decimal("2.0000"))]
    assert len(table(p, "fund_quarterly_return")) == 1


def test_star(first):
    _, p = first
    returns = [(r[0], r[1], r[2]) for r in table(p, "fact_nav_daily", "fund_id", "date_id", "daily_return")]
    assert returns == [
        (101, 20251230, None), (101, 20251231, Decimal("0.1")), (101, 20260102, Decimal("0.1")),
        (102, 20260102, None),
    ]
    assert len(table(p, "dim_date")) == 4
    assert len(table(p, "fact_manager_aum_monthly")) == 2
    assert [r[2] for r in table(p, "latest_nav", "fund_id", "nav_value", "daily_return")] == [Decimal("0.1"), None]


def test_contracts_hold(first):
    _, p = first
    assert integrity_report(p).collect() == []
    assert {r["table_name"]: r["n_rows"] for r in counts(p).collect()} == {
        name: n for name, n in p.counts.items() if name in p.folders
    }


def test_portfolio_report(spark, first):
    base, _ = first
    clean = Clean(spark, str(base / "work" / "20260701T080000"))
    anomalies, totals = portfolio_report(clean)
    assert [str(r["date_based"]) for r in anomalies.collect()] == ["2026-02-28"]
    assert totals.first()["allocation_near_full"] == 1


def test_reports(spark, first):
    base, p = first
    funds, aum, nav = (p.read(n) for n in ("mutual_fund", "aum_record", "nav_record"))
    totals = reports.class_totals(funds, aum).first()
    assert (totals["class_group_id"], totals["class_total_aum"], totals["n_classes"]) == (5, 1210, 1)
    unit = reports.unit_integrity(aum, nav).first()
    assert unit["total_units"] == 10 and unit["derived_units"] is None  # no price on 31 January
    facts = p.read("fact_nav_daily")
    (row,) = reports.category_volatility(facts, p.read("dim_category"), p.read("dim_date"), 2025).collect()
    assert (row["label"], row["n_fund"], row["ann_volatility"]) == ("Saham", 1, None)
    holders = reports.holders_of(
        "ABCD", p.read("security"), p.read("portfolio_holding"), p.read("portfolio_snapshot"), funds
    )
    assert [(r["name"], r["value_pct"]) for r in holders.collect()] == [("Alpha Kelas A", 7)]
    newest = batch_coverage(nav, "record_date", "scraped_at", 2).collect()
    assert [(str(r["record_date"]), r["n_rows"]) for r in newest] == [("2026-01-02", 2), ("2025-12-31", 1)]
    clean = Clean(spark, str(base / "work" / "20260701T080000"))
    labels = label_report(clean).first()
    assert (labels["checked"], labels["mismatches"], labels["rule_holds"]) == (4, 2, False)
    points = benchmark_return(p.read("benchmark_data_point")).collect()
    assert [(r["benchmark_id"], r["daily_return"]) for r in points] == [(79, None)]
    landed = {(r["source"], r["status"]): r["n_documents"] for r in landing_report(spark, str(base / "raw")).collect()}
    assert landed["portfolio", "empty"] == 1 and landed["snapshot", "failed"] == 1
    assert pending_quarters(spark, str(base / "raw")).count() == 5 * 5 - 1
    assert pending_quarters(spark, str(base / "raw"), force=True).count() == 25
    assert {r[0] for r in p.read("reject_log").select("table_name").collect()} == set()


def test_second_run_changes_nothing(spark, first):
    base, p = first
    again = refresh(spark, str(base / "raw"), str(base / "work"), str(base / "root"), datetime(2026, 7, 2, 8), full=True, rating_field="ProviderRating")
    assert again.counts == p.counts
    for name in p.folders:
        columns = [c for c in p.read(name).columns if c not in ("scraped_at", "personnel_id", "shareholder_id")]
        assert table(again, name, *columns) == table(p, name, *columns), name
    assert table(again, "nav_record", "scraped_at") == table(p, "nav_record", "scraped_at")
    assert table(again, "mutual_fund", "scraped_at")[0][0] == datetime(2026, 7, 2, 8)


def test_changed_sources(spark, first, tmp_path):
    base, p = first
    root = tmp_path / "root"
    shutil.copytree(base / "root", root)
    # The list of folders names the first root; the copy starts from its newest line.
    raw = write_raw(tmp_path / "raw", rename=True, more_days=True)
    changed = refresh(spark, str(raw), str(tmp_path / "work"), str(root), datetime(2026, 8, 1, 8), rating_field="ProviderRating")
    log = {(r["table_name"], r["record_pk"]) for r in changed.read("audit_log").collect()}
    assert log == {("investment_manager", "1"), ("mutual_fund", "102")}
    versions = table(changed, "dim_manager", "manager_id", "name", "valid_to", "is_current")
    assert [(v[0], v[1], v[3]) for v in versions] == [
        (1, "Manager One", False), (1, "Manager One Renamed", True), (2, "Manager Two", True),
    ]
    # The late first of January changes no return that is already stored.
    returns = [(r[1], r[2]) for r in table(changed, "fact_nav_daily", "fund_id", "date_id", "daily_return")]
    assert returns == [
        (20251230, None), (20251231, Decimal("0.1")), (20260101, Decimal("0.18181818")),
        (20260102, Decimal("0.1")), (20260202, Decimal("-0.5")), (20260102, None),
    ]
    newest = table(changed, "latest_nav", "fund_id", "nav_value", "daily_return")[0]
    assert newest == (101, Decimal("60.5000"), Decimal("-0.5"))
    assert table(changed, "security", "security_id", "code") == table(p, "security", "security_id", "code")


def test_daily_scope_touches_only_its_tables(spark, first, tmp_path):
    base, p = first
    assert "portfolio_holding" not in tables_of("daily") and "nav_record" in tables_of("daily")
    root = tmp_path / "root"
    shutil.copytree(base / "root", root)
    raw = write_raw(tmp_path / "raw", more_days=True)
    daily = refresh(spark, str(raw), str(tmp_path / "work"), str(root), datetime(2026, 8, 2, 8), scope="daily", rating_field="ProviderRating")
    assert daily.counts["nav_record"] == p.counts["nav_record"] + 2
    assert daily.folders["portfolio_holding"] == p.folders["portfolio_holding"]


def test_readers_see_whole_batches(spark, first):
    base, _ = first
    before = Published(spark, str(base / "root"))
    writer = Published(spark, str(base / "root"))
    writer.replace("fund_class", writer.read("fund_class").limit(0), "half")
    assert table(Published(spark, str(base / "root")), "fund_class") == table(before, "fund_class")


def test_subset(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    run = refresh(spark, str(raw), str(tmp_path / "work"), str(tmp_path / "root"), datetime(2026, 7, 1), subset=1, rating_field="ProviderRating")
    assert table(run, "mutual_fund", "fund_id") == [(101,)]
    assert {r[0] for r in table(run, "nav_record", "fund_id")} == {101}
    assert len(table(run, "investment_manager")) == 2


def test_new_documents_land_once(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    folder, landed, marks = str(raw / "snapshot"), str(tmp_path / "landed"), str(tmp_path / "marks")
    land_new(spark, folder, landed, marks)
    assert spark.read.parquet(landed).count() == 5
    land_new(spark, folder, landed, marks)
    assert spark.read.parquet(landed).count() == 5
    shutil.copy(raw / "snapshot" / "102.json", raw / "snapshot" / "106.json")
    land_new(spark, folder, landed, marks)
    assert sorted(r[0] for r in spark.read.parquet(landed).select("file_key").collect()) == [
        "101", "102", "103", "104", "105", "106",
    ]


def test_rows_that_break_a_contract_are_logged(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    rows = [(1, "fine", 0), (2, None, 1), (3, "x" * 101, 2), (None, "no key", 3), (1, "second", 4)]
    new = spark.createDataFrame(rows, "benchmark_id int, name string, pos int")
    audit, bad = merge_table(published, "benchmark", new, "b1", datetime(2026, 7, 1), "me")
    assert audit is None and table(published, "benchmark") == [(1, "fine")]
    assert sorted(r["reject_reason"] for r in bad.collect()) == [
        "benchmark_id given", "name fits 100", "name given",
    ]
    wide = spark.createDataFrame([(1, 7, 5, "123456789012.5")], "fund_id int, period_code int, beta int, cagr string")
    wide = wide.withColumn("as_of_date", F.lit("2026-01-01"))
    _, bad = merge_table(published, "fund_performance", wide, "b1", datetime(2026, 7, 1), "me")
    assert [r["reject_reason"] for r in bad.collect()] == ["cagr does not fit"]
    assert published.counts["fund_performance"] == 0


def test_compact_keeps_the_rows(spark, tmp_path):
    published = Published(spark, str(tmp_path))
    for i, batch in enumerate(("a", "b")):
        published.append("benchmark", spark.createDataFrame([(i, batch)], "benchmark_id int, name string"), batch)
        published.publish(batch)
    assert len(published.folders["benchmark"]) == 2
    published.compact("benchmark", "c")
    published.publish("c")
    again = Published(spark, str(tmp_path))
    assert len(again.folders["benchmark"]) == 1 and table(again, "benchmark") == [(0, "a"), (1, "b")]


def test_nothing_landed(spark, tmp_path):
    (tmp_path / "raw" / "snapshot").mkdir(parents=True)
    run = refresh(spark, str(tmp_path / "raw"), str(tmp_path / "work"), str(tmp_path / "root"), datetime(2026, 7, 1), rating_field="ProviderRating")
    assert set(run.counts.values()) == {0}
    assert integrity_report(run).collect() == []
    write_raw(tmp_path / "raw")
    run = refresh(spark, str(tmp_path / "raw"), str(tmp_path / "work"), str(tmp_path / "root"), datetime(2026, 7, 2), rating_field="ProviderRating")
    assert run.counts["fact_nav_daily"] == run.counts["nav_record"] == 4


def test_late_dimension_and_misfit_by_default(spark, tmp_path):
    """Prices of a fund whose manager lands a day later become facts then, without
    a full run; a return that does not fit its column is logged."""
    from dimflow.plans.mart import load_mart

    day = [datetime(2026, 1, d).date() for d in (1, 2, 5)]

    def fund(i, manager):
        return {"fund_id": i, "name": f"f{i}", "manager_id": manager, "bank_id": 1,
                "conservative_label": "Saham", "fund_type": 1, "currency": 0}

    def frame(p, name, rows):
        schema = p.read(name).schema
        full = [tuple(r.get(f.name) for f in schema) for r in rows]
        return spark.createDataFrame(full, schema)

    def nav(i, d, value):
        return {"fund_id": i, "record_date": d, "nav_value": Decimal(value)}

    p = Published(spark, str(tmp_path / "root"))
    p.replace("mutual_fund", frame(p, "mutual_fund", [fund(1, 1), fund(2, 2)]), "a")
    p.replace("investment_manager", frame(p, "investment_manager", [{"manager_id": 1, "name": "m"}]), "a")
    p.replace("custodian_bank", frame(p, "custodian_bank", [{"bank_id": 1, "name": "b"}]), "a")
    prices = [nav(1, day[0], "1"), nav(2, day[0], "1"), nav(2, day[1], "2"), nav(1, day[1], "100000")]
    p.append("nav_record", frame(p, "nav_record", prices), "a")
    load_mart(p, "a", day[0])
    p.publish("a")
    assert table(p, "fact_nav_daily", "fund_id", "date_id") == [(1, 20260101)]
    assert table(p, "fact_waiting", "owner_id") == [(2,), (2,)]
    assert table(p, "reject_log", "table_name", "record_pk") == [("fact_nav_daily", "20260102,1")]
    for batch in ("b", "c"):  # the second of them changes nothing
        p = Published(spark, str(tmp_path / "root"))
        managers = [{"manager_id": i, "name": "m"} for i in (1, 2)]
        p.replace("investment_manager", frame(p, "investment_manager", managers), batch)
        if batch == "b":
            p.append("nav_record", frame(p, "nav_record", [nav(2, day[2], "3")]), batch)
        load_mart(p, batch, day[1])
        p.publish(batch)
        got = table(p, "fact_nav_daily", "fund_id", "date_id", "daily_return")
        assert got == [
            (1, 20260101, None), (2, 20260101, None), (2, 20260102, Decimal("1")),
            (2, 20260105, Decimal("0.5")),
        ]
        assert table(p, "fact_waiting") == []
        assert table(p, "latest_nav", "fund_id", "nav_value", "daily_return")[1] == (
            2, Decimal("3"), Decimal("0.5"),
        )
        assert p.read("dim_date").count() == 5


def test_default_run_is_repeatable(spark, first, tmp_path):
    base, p = first
    root = tmp_path / "root"
    shutil.copytree(base / "root", root)
    again = refresh(spark, str(base / "raw"), str(tmp_path / "work"), str(root), datetime(2026, 7, 3, 8),
                    rating_field="ProviderRating")
    for name in p.folders:
        if name not in ("audit_log", "reject_log"):
            columns = [c for c in p.read(name).columns if c not in ("scraped_at", "personnel_id", "shareholder_id")]
            assert table(again, name, *columns) == table(p, name, *columns), name


def test_every_whole_document_is_read(spark, tmp_path):
    bodies = {
        "newline": '\n[{"Id": 1}]', "tab": '\t[{"Id": 2}]\r\n', "space": '  [{"Id": 3}] ',
        "nan": '[{"Id": 4, "x": NaN}]', "trailing": '[{"Id": 5}] x', "twice": '[{"Id": 6}][{"Id": 7}]',
        "more": '[{"Id": 8}], "q": [1]', "cut": '[{"Id": 9}', "blank": " \n", "empty": "\n[]", "null": " null\n",
        "closes": '[{"Id": 11}]],"q":[[2]', "again": '[{"Id": 11}]],"~document":[[{"Id": 12}]',
        "failed": '\n{"_error": null}', "object": '\n{"Id": 10}', "number": "5",
    }
    for name, body in bodies.items():
        (tmp_path / f"{name}.json").write_text(body)
    found = docs.read_documents(spark, str(tmp_path))
    arrays = docs.parse_arrays(found, "Id int")
    assert sorted(r["Id"] for r in arrays.collect()) == [1, 2, 3, 4]
    assert [r["Id"] for r in docs.parse_objects(found, "Id int").collect()] == [10]
    status = found.select("file_key", docs.document_status(F.col("body")).alias("s"))
    want = {n: "unreadable" for n in ("trailing", "twice", "more", "cut", "blank", "number", "closes", "again")}
    want |= {n: "data" for n in ("newline", "tab", "space", "nan", "object")}
    want |= {"empty": "empty", "null": "null", "failed": "failed"}
    assert {r["file_key"]: r["s"] for r in status.collect()} == want


def test_refresh_from_landed_tables(spark, first, tmp_path):
    base, p = first
    for name in FOLDERS:
        folder = base / "raw" / name
        if folder.exists():
            land_new(spark, str(folder), str(tmp_path / "landed" / name), str(tmp_path / "progress" / name))
    run = refresh(spark, str(base / "raw"), str(tmp_path / "work"), str(tmp_path / "root"),
                  datetime(2026, 7, 1, 8), rating_field="ProviderRating", landed=str(tmp_path / "landed"))
    assert run.counts == p.counts


def test_pending_documents_and_missing_masters(spark, first):
    base, _ = first
    raw = str(base / "raw")
    ids = {r["Id"] for r in docs.parse_arrays(docs.read_documents(spark, f"{raw}/fund_index.json"), "Id int").collect()}
    have = {int(f.stem) for f in (base / "raw" / "snapshot").glob("*.json") if f.stem.isdigit()}
    assert {r["id"] for r in pending_documents(spark, raw, "snapshot").collect()} == ids - have
    assert {r["id"] for r in pending_documents(spark, raw, "snapshot", force=True).collect()} == ids
    nowhere = {(r["source"], r["status"]) for r in landing_report(spark, f"{raw}/nowhere").collect()}
    assert nowhere == {(m, "missing") for m in ("managers", "banks", "sales", "fund_index")}
