"""Cleaning steps against the values the sources are known to send."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from dimflow.functions import checks, dates, labels, text


def apply(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    found = df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in found]


def as_values(spark, values, expression):
    """The same for VARIANT input, given as JSON texts."""
    return apply(spark, values, lambda c: expression(F.parse_json(c)))


def test_blank_text(spark):
    raw = [None, "-", "  -  ", "   ", "  Jakarta  ", "\t x \n"]
    assert apply(spark, raw, text.blank_to_null) == [None, None, None, None, "Jakarta", "x"]
    assert apply(spark, ["-"], lambda c: text.blank_to_null(c, dash_null=False)) == ["-"]


def test_whole_number(spark):
    raw = [None, "Rp 1.000.000", "-", "", "-500", "5000.50", "1-", "Rp"]
    want = [None, 1000000, None, None, -500, 500050, None, None]
    assert apply(spark, raw, text.whole_number) == want


def test_whole_number_of_numbers_and_text(spark):
    raw = ["5000", "5000.7", "-5000.7", '"Rp 1.000"', '"5000.7"', "null", None, "9007199254740993"]
    want = [5000, 5000, -5000, 1000, 50007, None, None, 9007199254740993]
    assert as_values(spark, raw, text.whole_number_value) == want


def test_decimal_number(spark):
    assert apply(spark, [None, "2,00%", "-", "12.5", "1.234,56"], text.decimal_number) == [
        None, 2.0, None, 12.5, None,
    ]
    assert as_values(spark, ["12.5", "12", '"2,00%"'], text.decimal_number_value) == [12.5, 12.0, 2.0]


def test_fee_percent(spark):
    raw = [None, "Maks 0,30%", "2,000%", "n/a", "-1,5 up to 3"]
    assert apply(spark, raw, text.fee_percent) == [None, 0.3, 2.0, None, -1.5]
    assert as_values(spark, ["0.25", '"Maks 3%"', "null"], text.fee_percent_value) == [0.25, 3.0, None]


def test_flag_tells_absent_from_null(spark):
    raw = [None, "null", "true", "false"]
    got = apply(spark, raw, lambda c: text.flag_value(F.parse_json(c), absent=True))
    assert got == [True, False, True, False]


def test_dates(spark):
    raw = [None, "", "2005-05-25T00:00:00", "18-08-2023", "not-a-date", "2024-02-30"]
    want = [None, None, date(2005, 5, 25), date(2023, 8, 18), None, None]
    assert apply(spark, raw, dates.parse_date) == want


def test_published_date_and_key(spark):
    days = [date(2026, 6, 5), date(2026, 7, 1), date(2024, 2, 10), date(2026, 2, 10)]
    want = [date(2026, 6, 30), date(2026, 7, 31), date(2024, 2, 29), date(2026, 2, 28)]
    assert apply(spark, days, dates.published_date, "date") == want
    assert apply(spark, days, dates.date_key, "date") == [20260605, 20260701, 20240210, 20260210]


def test_calendar_columns(spark):
    df = spark.createDataFrame([(date(2026, 1, 4),)], "d date")
    row = df.select(*dates.calendar_columns(F.col("d"))).first().asDict()
    assert row["day_name"] == "Sunday" and row["month_name"] == "January"
    assert (row["week"], row["quarter"], row["is_weekday"]) == (1, 1, False)


def test_latest_date(spark):
    kind = "array<struct<Date:string>>"
    values = [[], None, [("2026-03-01",), ("2026-03-05T00:00:00",), (None,), ("04-03-2026",)]]
    got = apply(spark, values, lambda c: dates.latest_date(c, "Date"), kind)
    assert got == [None, None, date(2026, 3, 5)]


@pytest.mark.parametrize(
    "name, base, suffix",
    [
        ("Some Fund Kelas A", "Some Fund", "Kelas A"),
        ("X  KELAS  b 2", "X", "Kelas b 2"),
        ("Plain", "Plain", None),
        ("Kelas A", "Kelas A", None),
        ("A kelas B kelas C", "A", "Kelas B kelas C"),
    ],
)
def test_class_suffix(spark, name, base, suffix):
    assert apply(spark, [name], text.name_without_suffix) == [base]
    assert apply(spark, [name], text.class_name) == [suffix]


def test_label_order(spark):
    rows = [(7, True, True), (7, False, True), (7, False, False), (0, False, True), (1, False, None),
            (2, None, False), (3, False, False), (4, False, False), (5, False, False), (None, False, False)]
    df = spark.createDataFrame(rows, "t int, i boolean, e boolean")
    got = [r[0] for r in df.select(labels.conservative_label(F.col("t"), F.col("i"), F.col("e"))).collect()]
    assert got == ["Indeks", "Exchange Traded Fund", "Reksadana Global", "Campuran", "Saham",
                   "Pendapatan Tetap", "Pasar Uang", "Terproteksi", "Lainnya", "Lainnya"]


def test_currency(spark):
    assert apply(spark, [0, 1, None], labels.currency_code, "int") == ["IDR", "USD", "USD"]


def test_corrections(spark):
    assert apply(spark, [-1.0, 100000.0, None], checks.non_negative, "double") == [None, 100000.0, None]
    fees = apply(spark, [200.0, 1.0, 100.0], lambda c: checks.below(c, 100), "double")
    assert fees == [None, 1.0, None]
    pct = apply(spark, [0.0, 102.52, -2.52, 60.0, 100.0], lambda c: checks.within(c, 0, 100), "double")
    assert pct == [0.0, None, None, 60.0, 100.0]
    ratio = apply(spark, [-30098.0, 12.5, None], lambda c: checks.magnitude_below(c, 10000), "double")
    assert ratio == [None, 12.5, None]


def test_first_given_and_nonzero(spark):
    assert apply(spark, ["", None, "a"], lambda c: text.first_given(c, F.lit("b"))) == ["b", "b", "a"]
    assert apply(spark, [0, None, 3], lambda c: text.first_nonzero(c, F.lit(7)), "int") == [7, 7, 3]


def test_row_image_writes_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert df.select(checks.row_image([F.col("a"), F.col("b")])).first()[0] == '{"a":1,"b":null}'
