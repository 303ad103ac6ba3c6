"""Codes to labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the fund type codes.
TYPE_LABELS = {
    0: "Campuran",
    1: "Saham",
    2: "Pendapatan Tetap",
    3: "Pasar Uang",
    4: "Terproteksi",
}
GLOBAL_TYPE = 7
GLOBAL_LABEL = "Reksadana Global"
ETF_LABEL = "Exchange Traded Fund"
INDEX_LABEL = "Indeks"
OTHER_LABEL = "Lainnya"

# Currency codes.
HOME_CURRENCY_CODE = 0
HOME_CURRENCY = "IDR"
OTHER_CURRENCY = "USD"


def code_label(code: Column, labels: dict, other: str) -> Column:
    label = F.lit(other)
    for value, text in labels.items():
        label = F.when(code == value, F.lit(text)).otherwise(label)
    return label


def conservative_label(fund_type: Column, is_index: Column, is_etf: Column) -> Column:
    """An index fund is labelled so whatever its type; a global fund depends on
    whether it is exchange traded; every other type has its own label."""
    return (
        F.when(is_index, F.lit(INDEX_LABEL))
        .when((fund_type == GLOBAL_TYPE) & is_etf, F.lit(ETF_LABEL))
        .when(fund_type == GLOBAL_TYPE, F.lit(GLOBAL_LABEL))
        .otherwise(code_label(fund_type, TYPE_LABELS, OTHER_LABEL))
    )


def currency_code(code: Column) -> Column:
    return F.when(code == HOME_CURRENCY_CODE, F.lit(HOME_CURRENCY)).otherwise(F.lit(OTHER_CURRENCY))
