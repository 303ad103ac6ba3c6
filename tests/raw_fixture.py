"""A small landing folder with every kind of fault the source is known for."""

import json
from pathlib import Path


def _dump(path: Path, data) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(data), encoding="utf-8")


def snapshot(fund_id, nav, aum=(), units=(), detail=None, **more):
    return {
        "Detail": detail,
        "NetAssetValues": [{"Date": d, "Value": v, "ClassTotalValue": None} for d, v in nav],
        "AssetUnderManagements": [{"Date": d, "Value": v} for d, v in aum],
        "TotalUnits": [{"Date": d, "Value": v} for d, v in units],
        **more,
    }


def write_raw(root: Path, rename: bool = False, more_days: bool = False) -> Path:
    """``rename`` changes one manager and one fund; ``more_days`` adds values."""
    _dump(
        root / "managers.json",
        [
            {
                "Id": 1,
                "Name": "Manager One Renamed" if rename else "Manager One",
                "OjkCode": "M01",
                "MiPermitNum": " - ",
                "TelephoneNumber": " 021 ",
                "Capital": "Rp 1.000.000",
                "PaidInCapital": 5000.7,
                "DataLastUpdate": "18-08-2023",
                "Personnel": [{"Name": "A", "Title": "CEO"}, {"Name": "B", "Title": "CFO"}],
                "Share": [{"Name": "S", "Share": "100"}],
            },
            {
                "Id": 2,
                "Name": "Manager Two",
                "OjkCode": "M02",
                "IsActive": None,
                "Personnel": None,
                "Share": None,
            },
        ],
    )
    _dump(
        root / "banks.json",
        [{"Id": 10, "Name": "Bank", "TelephoneNumber": "1" * 55, "OwnershipStatus": "Nasional"}],
    )
    _dump(root / "sales.json", [{"Id": 7, "Name": "Seller", "AperdId": "P7"}])

    def fund(i, name, **more):
        return {
            "Id": i,
            "Name": name,
            "InvestmentManagerId": 1 + i % 2,
            "CustodianBankId": 10,
            "Type": 1,
            "Currency": 0,
            "Sharia": False,
            "ConservativeCategory": "Saham",
            **more,
        }

    _dump(
        root / "fund_index.json",
        [
            {"Id": 0, "Name": "An index", "Type": 1},
            fund(101, "Alpha Kelas A", IsinCode="X1"),
            fund(102, "Alpha KELAS B New" if rename else "Alpha KELAS B", IsinCode="X1"),
            fund(103, "Gamma", Type=7, ExchangeTradedFund=True, Currency=1, IsinCode="-"),
            fund(104, "Delta", Type=4, ConservativeCategory="Saham", IsinCode=None),
        ],
    )
    _dump(
        root / "products" / "1.json",
        [{"Fund": {"Id": 101, "FkClassFundId": 5}}, {"Fund": {"Id": 102, "FkClassFundId": 5}},
         {"Fund": {"Id": 103, "FkClassFundId": 0}}, {"Fund": None}],
    )
    _dump(root / "products" / "2.json", {"not": "a list"})
    _dump(
        root / "manager_aum" / "1.json",
        [{"fkFundManager": 1, "Date": "2026-01-01T00:00:00", "Aum": 10.5, "TotalUnit": 2},
         {"fkFundManager": 0, "Date": "2026-02-01", "Aum": 11, "TotalUnit": None},
         {"Date": "2026-03-01", "Aum": -1}, {"Date": None, "Aum": 3}],
    )
    nav = [
        ("2025-12-30T00:00:00", 100.0),
        ("2025-12-31T00:00:00", 110.0),
        ("2026-01-02T00:00:00", 121.0),
        ("2026-01-05T00:00:00", 0),
        ("2026-01-06T00:00:00", None),
        (None, 5.0),
    ]
    if more_days:
        nav = [*nav, ("2026-02-02T00:00:00", 60.5), ("2026-01-01T00:00:00", 130.0)]
    _dump(
        root / "snapshot" / "101.json",
        snapshot(
            101,
            nav,
            aum=[("2026-01-01", 1210.9), ("2026-02-01", None), ("2026-03-01", -5)],
            units=[("2026-01-01", 9.0), ("2026-01-01", 10.0)],
            detail={
                "IsActive": True,
                "IpoDate": "2005-05-25T00:00:00",
                "MinSubNum": "Rp 100.000",
                "MinNextSubNum": -1,
                "MaxSubscriptionFee": "Maks 0,30%",
                "MaxRedemptionFee": "200%",
                "InvestmentBond": "2,00%",
                "InvestmentEquity": 102.52,
                "InvestmentMoneyMarket": -2.52,
            },
            Performances=[
                {"Period": 1, "Return": 0.5, "TreynorRatio": -30098.0},
                {"Period": None, "Return": 0.1},
            ],
            Rankings=[
                {"Period": 1, "RiskRank": 0, "RatingRank": 0, "AllRiskRank": 0,
                 "ProviderRating": 0, "RiskRating": 0, "AllRiskRating": 0},
                {"Period": 2, "Category": 3, "RiskRank": 3, "RatingRank": 1, "AllRiskRank": 2,
                 "ProviderRating": 4.5, "RiskRating": 1, "AllRiskRating": 5},
            ],
            Benchmark={"Id": 79},
            Benchmarks=[
                {"Id": 79, "Name": "IX", "Data": [{"Date": "2026-01-01", "Value": None},
                                                  {"Date": "2026-01-01", "Value": 7000.5},
                                                  {"Date": "2026-01-01", "Value": 1.0}]},
                {"Id": 93, "Name": "LQ", "Data": None},
                {"Id": 79, "Name": "IX again"},
            ],
        ),
    )
    _dump(root / "snapshot" / "102.json", snapshot(102, [("2026-01-02", 50.0)]))
    _dump(root / "snapshot" / "103.json", None)
    _dump(root / "snapshot" / "104.json", {"_error": "timeout"})
    (root / "snapshot" / "105.json").write_text('{"broken": ')
    _dump(
        root / "portfolio" / "101.json",
        [
            {
                "DateBased": "2026-01-31",
                "DomesticAllocation": "60,5%",
                "ForeignAllocation": None,
                "Assets": [
                    {"Type": 0, "SpesificType": 0, "Name": "Saham", "Value": 69.9},
                    {"Type": 0, "SpesificType": 0, "Name": "Saham?", "Value": 21.8},
                    {"Type": 0, "SpesificType": 7, "Name": "Pasar Uang", "Value": 8.3},
                    {"Type": 0, "SpesificType": 9, "Name": "Pasar Uang", "Value": 120},
                    {"Type": 1, "Name": "x", "Value": 5.5, "fkStockId": 3,
                     "Stock": {"Code": "ABCD", "Name": "Company"}},
                    {"Type": 1, "Name": "x", "Value": 1.5, "Stock": {"Code": "ABCD"}},
                    {"Type": 2, "Name": "Bond Z", "Value": 3.0, "fkStockId": 9},
                    {"Type": 1, "Name": "no stock", "Value": 3.0, "Stock": None},
                ],
            },
            {"DateBased": None, "Assets": []},
            {"DateBased": "2026-02-28", "Assets": None},
        ],
    )
    _dump(root / "portfolio" / "102.json", [])
    _dump(root / "portfolio" / "999.json", [{"DateBased": "2026-01-31", "Assets": []}])
    _dump(
        root / "quarterly" / "101_2026.json",
        [{"Date": "2026-01-01", "Value": 0.05}, {"Date": "2026-04-01", "Value": None}],
    )
    _dump(root / "quarterly" / "999_2026.json", [{"Date": "2026-01-01", "Value": 0.05}])

    def link(fund_id, fee):
        return {"fkFundId": fund_id, "fkFundSalesCompanyId": 7, "CommissionFee": fee}

    _dump(
        root / "sales_companies" / "101.json",
        [{"FundSalesCompany": {"FundSalesCompanyFunds": [link(101, 1.0), link(101, 2.0)]}},
         {"FundSalesCompany": {"FundSalesCompanyFunds": [link(999, 1.0)]}},
         {"FundSalesCompany": None}],
    )
    return root
