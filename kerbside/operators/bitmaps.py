"""Exact sets of dense ids as mergeable bitmaps, a row of 4 KB per 32,768 ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmaps(rows: DataFrame, id_column: str, by: Sequence[str]) -> DataFrame:
    """(.., bucket, bits): the distinct non-null ids (1, 2, ..) of every group.

    A repeated id sets its bit again, so a hot id or group is combined before the shuffle.
    """
    known = rows.where(F.col(id_column).isNotNull())
    return known.groupBy(*by, F.bitmap_bucket_number(id_column).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(id_column))).alias("bits"))


def union_of(sets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One bitmap per group and bucket: ids in any of the given ones."""
    return sets.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def common_to(first: DataFrame, second: DataFrame) -> DataFrame:
    """(bucket, bits) of the ids that both have; each has a bitmap per bucket."""
    both = first.select("bucket", "bits").unionByName(second.select("bucket", "bits"))
    return both.groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n")).where("n = 2").drop("n")


def n_ids(sets: DataFrame) -> DataFrame:
    """One row, ``n``: ids of a set; 0 for an empty one."""
    return sets.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))
