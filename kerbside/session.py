"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SPREAD_CONF = "kerbside.spreadScansTo"
# HotSpot compiles no method of more bytes, and interprets it row by row.
METHOD_CONF, LONGEST_METHOD = "spark.sql.codegen.hugeMethodLimit", 8000


def build_session(app: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect.

    Shuffle width, executor memory and scan split size are left to the cluster:
    adaptive execution coalesces and splits partitions from real sizes.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def spread_setting(spark: SparkSession) -> int | None:
    """Over how many tasks unsplittable inputs are redistributed, if the session asks for it."""
    value = spark.conf.get(SPREAD_CONF, None)
    return int(value) if value else None


def compile_in_pieces(spark: SparkSession) -> None:
    """For plans with expressions over many columns: a stage whose generated method would be too long for the JIT
    compiler is generated operator by operator instead, in methods that it does compile.  No result depends on it."""
    if int(spark.conf.get(METHOD_CONF)) > LONGEST_METHOD:
        spark.conf.set(METHOD_CONF, LONGEST_METHOD)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="kerbside-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder
