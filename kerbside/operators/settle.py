"""Cutting lineage with a table written to the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from kerbside.sources.files import delete_tree, scratch_path

STORED_AS = {"compression": "zstd"}  # what is written once and read often: a third smaller than with the default codec


def _write(df: DataFrame, label: str) -> tuple[str, DataFrame]:
    path = scratch_path(df.sparkSession, label)
    df.write.options(**STORED_AS).parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result survives lost executors, is computed once however often it is
    read, and its real size is known to the planner.
    """
    return _write(df, label)[1]


@contextmanager
def settled(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The same for the length of a job: the copy is removed at its end."""
    path, stored = _write(df, label)
    try:
        yield stored
    finally:
        delete_tree(df.sparkSession, path)
