"""Using the whole cluster when the input is a few unsplittable files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_A_TASK = 250_000
SLICE = "_slice"


def spread(scan: DataFrame, tasks: int | None) -> DataFrame:
    """Redistribute a scan over so many tasks; without a number it stays as it is.

    One gzipped CSV or one Parquet row group is one task, and every stage up to
    the next shuffle would run on one core.  Whether a shuffle of all rows is
    worth it the caller knows; the plan does not depend on the cluster.
    """
    return scan if tasks is None else scan.repartition(tasks)


def deal(df: DataFrame, group: str, key: Column, sizes: Sequence[int]) -> DataFrame:
    """Rows dealt by a column of few values, a large one over several tasks by the key; ``_slice`` says to which.

    ``sizes`` are the rows of each value, so the number of tasks goes with the rows.  What groups by the column, the
    slice and whatever else finds its rows in place.
    """
    slices = max(1, -(-max(sizes, default=0) // ROWS_A_TASK))
    sliced = df.withColumn(SLICE, F.pmod(F.xxhash64(key), F.lit(slices)))
    return sliced.repartition(max(2, -(-sum(sizes) // ROWS_A_TASK)), group, SLICE)
