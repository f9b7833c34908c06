"""Surrogate ids that stay with their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.dense_id import dense_id


def new_ids(names: DataFrame, known: DataFrame, key: str, name: str = "name") -> DataFrame:
    """(key, name) of the distinct non-null names that ``known`` (key, name) lacks.

    They are numbered on in name order from the largest known id.  Names never change their id, and one that
    disappears keeps it: an anti-join and one number are all that is taken from the known ones.
    """
    missing = names.select(F.col(name)).where(F.col(name).isNotNull()).distinct().join(known.select(name), name, "left_anti")
    highest = known.agg(F.max(key)).first()[0] or 0
    return dense_id(missing, key, [name]).select((F.col(key) + highest).alias(key), name)
