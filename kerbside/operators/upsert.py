"""Latest-wins merge and insert-if-new."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

from kerbside.operators.keep_first import keep_first


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str],
           newest_first: Sequence[str | Column]) -> DataFrame:
    """Base rows whose key is not updated, plus the newest update of every key.

    Only the updates are ranked, and the base takes part in one anti-join on the
    keys: of a key that the base holds more than once and that is not updated,
    all rows stay.
    """
    return replaced(base, keep_first(updates, keys, newest_first), keys)


def replaced(base: DataFrame, newest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same for updates that have one row per key already: nothing is ranked."""
    changed = newest.select(*keys)
    kept = base.join(changed, _same_key(base, changed, keys), "left_anti")
    return kept.unionByName(newest.select(*base.columns))


def insert_new(stored: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is not stored yet: running a load twice adds nothing."""
    known = stored.select(*keys)
    return rows.join(known, _same_key(rows, known, keys), "left_anti")
