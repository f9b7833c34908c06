"""Dictionary lookups as left joins that cannot multiply rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, on: str, dim: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Add ``out`` = the dimension's ``value`` where ``key`` equals ``on``; a miss gives null.

    One value per key is enforced by grouping (the largest id wins, as the last
    entry wins in a dictionary), so no duplicate name can multiply fact rows.
    There is no broadcast hint: the planner knows the size of a stored
    dimension, broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and
    uses a shuffled join, with adaptive skew splitting, above.
    """
    pairs = (
        dim.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias(f"_key_{out}"))
        .agg(F.max(value).alias(out))
    )
    return fact.join(pairs, F.col(on) == F.col(f"_key_{out}"), "left").drop(f"_key_{out}")
