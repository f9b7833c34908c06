"""File-system questions, answered by whatever file system the path names, and scratch folders."""

from __future__ import annotations

import atexit
from uuid import uuid4

from pyspark import SparkContext
from pyspark.sql import SparkSession

from kerbside.session import shared_folder

_APPLICATION_FOLDERS: set[str] = set()


def _status(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _status(spark, path)
    return system.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty if there is no such folder."""
    system, target = _status(spark, path)
    if not system.exists(target):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(target))


def version_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time and length: changes when the stored data does."""
    system, target = _status(spark, path)
    return system.getFileStatus(target).getModificationTime(), system.getContentSummary(target).getLength()


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob pattern names anything."""
    system, target = _status(spark, pattern)
    found = system.globStatus(target)
    return found is not None and len(found) > 0


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder to one that is not there yet."""
    system, source = _status(spark, path)
    _, new = _status(spark, target)
    system.mkdirs(new.getParent())
    if system.exists(new) or not system.rename(source, new):
        raise OSError(f"cannot move {path} to {target}")


def delete_tree(spark: SparkSession, path: str) -> None:
    """Remove a folder of this program's own making, such as a run's staged rows."""
    system, target = _status(spark, path)
    system.delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, below a folder of this application that is removed when it ends.

    A lazily read result may still need its copy, so copies stay until then.
    """
    root = f"{shared_folder(spark)}/kerbside/{spark.sparkContext.applicationId}"
    if root not in _APPLICATION_FOLDERS:
        _APPLICATION_FOLDERS.add(root)
        atexit.register(_remove, spark, root)
    return f"{root}/{label}-{uuid4().hex}"


def _remove(spark: SparkSession, root: str) -> None:
    if SparkContext._active_spark_context is not None:
        delete_tree(spark, root)
