"""Corrections that null a value outside its plausible range."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of plausible source values.
FEE_LIMIT_PCT = 100
RATIO_LIMIT = 10000
TELEPHONE_WIDTH = 50


def non_negative(c: Column) -> Column:
    return F.when(c >= 0, c)


def below(c: Column, limit) -> Column:
    """The limit itself is nulled too."""
    return F.when(c < limit, c)


def within(c: Column, low, high) -> Column:
    return F.when(c.between(low, high), c)


def magnitude_below(c: Column, limit) -> Column:
    return F.when(F.abs(c) < limit, c)


def given(columns: list[str]) -> Column:
    """True where no column is null; reaches the file scan, unlike ``dropna``."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def all_zero(columns: list[Column]) -> Column:
    """True only where every column is zero; a null is not a zero."""
    return F.coalesce(reduce(and_, [c == 0 for c in columns]), F.lit(False))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is null on a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0).cast("int"))


def differs(left: list[Column], right: list[Column]) -> Column:
    """Row-value comparison in which null equals null."""
    return ~F.struct(*_positional(left)).eqNullSafe(F.struct(*_positional(right)))


def _positional(columns: list[Column]) -> list[Column]:
    return [c.alias(f"c{i}") for i, c in enumerate(columns)]


def row_image(columns: list[Column]) -> Column:
    """JSON text of a row; null fields are written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
