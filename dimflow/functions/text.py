"""Cleaning of text that carries names, money, percentages and fees.

Each function takes a Column and returns a Column, so the step stays inside
Spark's generated code.  The ``*_value`` forms take a VARIANT column, in which
a source number and a source text are still told apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

CLASS_SUFFIX = r"(?i)\s+(kelas\s+.+)$"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column, dash_null: bool = True) -> Column:
    """Trimmed text; empty text is null, and so is a lone dash unless kept."""
    text = F.nullif(strip(c), F.lit(""))
    return F.nullif(text, F.lit("-")) if dash_null else text


def whole_number(c: Column) -> Column:
    """Money text to bigint.  Dots, commas and currency marks are dropped, so
    ``"Rp 1.000.000"`` is 1000000; text without digits is null."""
    digits = F.regexp_replace(c, "[^0-9-]", "")
    return F.nullif(digits, F.lit("")).try_cast("bigint")


def decimal_number(c: Column) -> Column:
    """Text with a decimal comma or point to double: ``"2,00%"`` is 2.0."""
    kept = F.regexp_replace(F.translate(c, ",", "."), r"[^0-9.\-]", "")
    return F.nullif(kept, F.lit("")).try_cast("double")


def fee_percent(c: Column) -> Column:
    """First number found in a fee text: ``"Maks 0,30%"`` is 0.3."""
    found = F.regexp_extract(F.translate(c, ",", "."), r"(-?\d+\.?\d*)", 1)
    return F.nullif(found, F.lit("")).try_cast("double")


def _is_text(v: Column) -> Column:
    return F.schema_of_variant(v) == "STRING"


def whole_number_value(v: Column) -> Column:
    """Numbers are truncated, text goes through :func:`whole_number`."""
    return F.when(_is_text(v), whole_number(v.cast("string"))).otherwise(
        F.try_variant_get(v, "$", "bigint")
    )


def decimal_number_value(v: Column) -> Column:
    return F.when(_is_text(v), decimal_number(v.cast("string"))).otherwise(
        F.try_variant_get(v, "$", "double")
    )


def fee_percent_value(v: Column) -> Column:
    return fee_percent(F.try_variant_get(v, "$", "string"))


def flag_value(v: Column, absent: bool) -> Column:
    """Boolean of a VARIANT: ``absent`` when the field is missing, false when
    it is an explicit null."""
    return (
        F.when(v.isNull(), F.lit(absent))
        .when(F.is_variant_null(v), F.lit(False))
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "boolean"), F.lit(False)))
    )


def name_without_suffix(c: Column, pattern: str = CLASS_SUFFIX) -> Column:
    return strip(F.regexp_replace(c, pattern, ""))


def name_suffix(c: Column, pattern: str = CLASS_SUFFIX) -> Column:
    """The part of a name that ``pattern`` captures, or null."""
    return F.nullif(strip(F.regexp_extract(c, pattern, 1)), F.lit(""))


def class_name(c: Column) -> Column:
    """Share-class part of a fund name, with its leading word in one case."""
    return F.regexp_replace(name_suffix(c), r"(?i)^kelas\s+", "Kelas ")


def fit_width(c: Column, width: int) -> Column:
    return F.left(c, F.lit(width))


def first_given(first: Column, second: Column) -> Column:
    """``second`` where ``first`` is null or empty."""
    return F.coalesce(F.nullif(first, F.lit("")), second)


def first_nonzero(first: Column, second: Column) -> Column:
    """``second`` where ``first`` is null or zero."""
    return F.coalesce(F.nullif(first, F.lit(0)), second)
