"""Date parsing, date keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column) -> Column:
    """Date of an ISO text (a time part may follow) or of a day-first text.
    Any other text is null; keep the text itself in a reject table."""
    head = F.left(c, F.lit(10))
    return F.coalesce(F.try_to_date(head, "yyyy-MM-dd"), F.try_to_date(head, "dd-MM-yyyy"))


def published_date(c: Column) -> Column:
    """A month label is published on the last day of its month."""
    return F.last_day(c)


def date_key(c: Column) -> Column:
    """20240131 for 31 January 2024; integer arithmetic, no text formatting."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.day(c)).cast("int")


def calendar_columns(c: Column) -> list[Column]:
    return [
        date_key(c).alias("date_id"),
        c.alias("full_date"),
        F.day(c).cast("smallint").alias("day"),
        F.date_format(c, "EEEE").alias("day_name"),
        F.weekofyear(c).cast("smallint").alias("week"),
        F.month(c).cast("smallint").alias("month"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.quarter(c).cast("smallint").alias("quarter"),
        F.year(c).cast("smallint").alias("year"),
        (F.weekday(c) < 5).alias("is_weekday"),
    ]


def latest_date(items: Column, field: str) -> Column:
    """Latest date over an array of structs, read without exploding it."""
    return F.array_max(F.transform(items, lambda item: parse_date(item[field])))
