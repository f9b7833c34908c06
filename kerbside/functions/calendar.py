"""Month arithmetic on the driver and on columns."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(day: date | datetime) -> str:
    return f"{day.year:04d}-{day.month:02d}"


def month_start(month: str) -> date:
    """First day of a 'YYYY-MM' month."""
    year, number = month.split("-")
    return date(int(year), int(number), 1)


def next_month_start(month: str) -> date:
    first = month_start(month)
    return date(first.year + first.month // 12, first.month % 12 + 1, 1)


def in_month(column: Column, month: str) -> Column:
    """Half-open range on the raw column, so the predicate reaches the scan."""
    return (column >= F.lit(month_start(month))) & (column < F.lit(next_month_start(month)))


def month_of(column: Column) -> Column:
    """'YYYY-MM' text of a date column, without the cost of a pattern formatter."""
    return F.concat(F.lpad(F.year(column).cast("string"), 4, "0"), F.lit("-"),
                    F.lpad(F.month(column).cast("string"), 2, "0"))
