"""Load booking files as they arrive in a folder."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.plans.jobs import Counts, backfill, load_tidied
from kerbside.sources.ride_csv import CSV_OPTIONS, ORDER_PREFIX, record_schema, text_schema, tidy, with_file_order
from kerbside.sources.warehouse import Warehouse


def file_stream(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """New CSV files of a folder as a text stream with file name and position.

    Without a schema the header of a file already there gives the names.  Each
    file is parsed as a whole, so that quoted line ends are kept.
    """
    header = schema or text_schema(spark, folder)
    files = spark.readStream.schema(record_schema(header)).options(**CSV_OPTIONS, multiLine="true").csv(folder)
    return with_file_order(files, count_rows=False)


def ingest(spark: SparkSession, folder: str, warehouse_root: str, progress_folder: str, *,
           extraction_date: date | None = None, schema: T.StructType | None = None,
           on_bad_date: str = "reject") -> None:
    """Load every file not loaded before, then stop.

    The progress folder records which files were taken.  A batch repeated after
    a failure adds nothing, because only keys not stored yet are written: each
    row lands once.  Rows belong to the month of their own date, or, with an
    ``extraction_date``, only that month is taken.
    """
    warehouse = Warehouse(spark, warehouse_root)

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = tidy(batch.withColumn(f"{ORDER_PREFIX}2", F.monotonically_increasing_id()))
        load_tidied(warehouse, rows, extraction_date, label="followed", mode="add_new", on_bad_date=on_bad_date)

    query = (
        file_stream(spark, folder, schema).writeStream
        .foreachBatch(load).option("checkpointLocation", progress_folder)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def ingest_and_refresh(spark: SparkSession, folder: str, warehouse_root: str, progress_folder: str, *,
                       extraction_date: date | None = None, on_bad_date: str = "reject",
                       run_ts: datetime | None = None) -> dict[str, Counts]:
    """Load the new files, then rebuild Silver and Gold once."""
    ingest(spark, folder, warehouse_root, progress_folder, extraction_date=extraction_date, on_bad_date=on_bad_date)
    return backfill(spark, warehouse_root, run_ts=run_ts)
