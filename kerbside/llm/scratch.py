"""Tables and files an operator keeps in the shared folder while it runs."""

from __future__ import annotations

import atexit
from uuid import uuid4

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from kerbside.session import shared_folder
from kerbside.sources.files import delete_tree

_ROOTS: set[str] = set()


def _clear(spark: SparkSession, root: str) -> None:
    if SparkContext._active_spark_context is not None:
        delete_tree(spark, root)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, below a folder of this application that goes when it ends.

    A lazily read result may still need its tables, so they stay until then.
    """
    root = f"{shared_folder(spark)}/kerbside-llm/{spark.sparkContext.applicationId}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_clear, spark, root)
    return f"{root}/{label}-{uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write and reread ``df``: lineage ends at files that outlive executors, and its size is known to the planner."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
