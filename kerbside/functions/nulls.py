"""Null handling that scans can use."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_present(*columns: str) -> Column:
    """True where none of the columns is null; each test can be pushed to the scan.

    Grouping keeps a null key in Spark; the aggregates here leave such rows out.
    """
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
