"""Numbering rows in order, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.scratch import stored


def numbered(rows: DataFrame, name: str, order: list[str], group: str | None = None) -> DataFrame:
    """``rows`` with a column ``name``: the place, from 1, in ``order`` (nulls first) among all or among those of a group.

    Rows are range-partitioned by group and order, numbered within their range, and moved on by the number of the
    group's rows in earlier ranges: a group of any size is shared between tasks.
    """
    groups = [group] if group else []
    ranged = stored(rows.repartitionByRange(*groups, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = ranged.withColumn(name, F.row_number().over(Window.partitionBy("_range", *groups).orderBy(*order)).cast("long"))
    sizes = stored(ranged.groupBy("_range", *groups).agg(F.count("*").alias("_size")), "range-sizes")
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    moved = sizes.select("_range", *groups, F.sum("_size").over(earlier).alias("_moved")).where(F.col("_moved") > 0)
    known = stored(moved, "range-offsets")  # groups that lie in several ranges: no more than ranges
    return inside.join(F.broadcast(known), ["_range", *groups], "left").withColumn(
        name, F.col(name) + F.coalesce("_moved", F.lit(0))).drop("_range", "_moved")
