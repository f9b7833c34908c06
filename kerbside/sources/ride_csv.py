"""The booking file: untidy CSV text to a typed, month-stamped frame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions.calendar import in_month, month_key, month_of
from kerbside.functions.text import clean_text, na_to_null, to_date, to_number
from kerbside.operators.spread import spread
from kerbside.schemas import OPTIONAL_SOURCE_COLUMNS, SOURCE_COLUMNS

REPEATED = "_repeated"  # whether another row may have the booking id and month of this one
ORDER_PREFIX = "_ord_"
DATE_TEXT = "_date_text"
BAD_RECORD = "_bad_record"  # text of a record with more fields than the header has, else null
SOURCE_PATH = f"{ORDER_PREFIX}0"  # full path of the file: two folders may hold files of the same name
CSV_OPTIONS = {"header": "true", "escape": '"', "enforceSchema": "false", "columnPruning": "false"}
_PARSED = "_corrupt_record"


def order_columns(df: DataFrame) -> list[str]:
    """The hidden columns that carry the row order of the source."""
    return [c for c in df.columns if c.startswith(ORDER_PREFIX)]


def text_schema(spark: SparkSession, path: str | Sequence[str]) -> T.StructType:
    """Header names of the file, every column as text; reads one line."""
    return spark.read.options(**CSV_OPTIONS).csv(path).schema


def record_schema(header: T.StructType) -> T.StructType:
    """The header's columns and one that keeps the text of records with another number of fields."""
    return T.StructType([*header.fields, T.StructField(_PARSED, T.StringType())])


def has_records_over_lines(spark: SparkSession, path: str | Sequence[str]) -> bool:
    """Whether a quoted field may go on after a line's end: only then a line has an odd number of quotes.

    One scan of the bare lines.  Files without such a line are parsed in splits; one that has it is parsed as a
    whole, as no split can tell where its first record begins.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    paths = [path] if isinstance(path, str) else list(path)
    return not spark.read.text(paths).where(quotes % 2 == 1).isEmpty()


def _n_fields(record: Column) -> Column:
    """Fields of a record: commas outside of quotes, and one.  Doubled quotes open and close, so they change nothing."""
    outside = F.filter(F.split(record, '"'), lambda part, i: i % 2 == 0)
    commas = F.transform(outside, lambda part: F.length(part) - F.length(F.replace(part, F.lit(","), F.lit(""))))
    return F.aggregate(commas, F.lit(1), lambda total, n: total + n)


def with_file_order(scan: DataFrame, *, count_rows: bool = True) -> DataFrame:
    """Trim the header names and add the bad record, file name and row order.

    The order columns are taken in the scan's own projection, where the row
    counter follows the file blocks; a stream has no row counter.
    """
    counter = [F.monotonically_increasing_id().alias(f"{ORDER_PREFIX}2")] if count_rows else []
    names = [c for c in scan.columns if c != _PARSED]
    too_many = F.col(_PARSED).isNotNull() & (_n_fields(F.col(_PARSED)) > len(names))
    return scan.select(
        *[F.col(f"`{c}`").alias(c.strip()) for c in names],
        F.when(too_many, F.col(_PARSED)).alias(BAD_RECORD),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias(SOURCE_PATH),
        F.col("_metadata.file_block_start").alias(f"{ORDER_PREFIX}1"),
        *counter,
    )


def read_raw(spark: SparkSession, path: str | Sequence[str], *, spread_to: int | None = None) -> DataFrame:
    """All columns as text, header names trimmed, doubled quotes decoded, quoted line ends kept.

    A record with fewer fields than the header has null for the others; one with more is marked in ``_bad_record``.
    """
    over_lines = str(has_records_over_lines(spark, path)).lower()
    reader = spark.read.options(**CSV_OPTIONS, multiLine=over_lines).schema(record_schema(text_schema(spark, path)))
    return spread(with_file_order(reader.csv(path)), spread_to)


def tidy(raw: DataFrame) -> DataFrame:
    """Missing-value tokens to null, text cleaned, numbers and dates typed.

    A date text that does not parse stays visible in ``_date_text``, a record with too many fields in ``_bad_record``.
    """
    present = set(raw.columns)
    lacking = [h for h, c, _ in SOURCE_COLUMNS if h not in present and c not in OPTIONAL_SOURCE_COLUMNS]
    if lacking:
        raise ValueError(f"source columns missing: {lacking}")
    columns = []
    for header, name, kind in SOURCE_COLUMNS:
        if header not in present:
            columns.append(F.lit(None).cast(kind).alias(name))
            continue
        text = clean_text(na_to_null(F.col(f"`{header}`")))
        if kind == "date":
            columns.append(to_date(text).alias(name))
            columns.append(text.alias(DATE_TEXT))
        else:
            columns.append((to_number(text) if kind == "double" else text).alias(name))
    bad = F.col(BAD_RECORD) if BAD_RECORD in present else F.lit(None).cast("string").alias(BAD_RECORD)
    return raw.select(*columns, bad, "source_file", *order_columns(raw))


def _bad_date() -> Column:
    return F.col("date").isNull() & F.col(DATE_TEXT).isNotNull()


def rejected(tidied: DataFrame) -> DataFrame:
    """Records with too many fields, and rows whose date text is present but no date; ``reason`` says which."""
    reason = F.when(F.col(BAD_RECORD).isNotNull(), "fields").when(_bad_date(), "date")
    return tidied.withColumn("reason", reason).where(F.col("reason").isNotNull())


def stamp(tidied: DataFrame, extraction_date: date | None, *, no_date_filter: bool = False,
          on_bad_date: str = "reject") -> DataFrame:
    """Month slice and lineage columns.

    With an ``extraction_date`` the rows of its month are kept (all rows with
    ``no_date_filter``) and stamped with it.  Without one, every row is stamped
    with the month of its own date: many months in one scan.
    ``on_bad_date`` is "reject" (leave such rows and records with too many fields
    to ``rejected``) or "fail" (stop the run).
    """
    rows = tidied
    if BAD_RECORD in tidied.columns:
        if on_bad_date == "fail":
            message = F.concat(F.lit("too many fields: "), F.col(BAD_RECORD))
            rows = rows.where(F.when(F.col(BAD_RECORD).isNull(), True).otherwise(F.raise_error(message).cast("boolean")))
        else:
            rows = rows.where(F.col(BAD_RECORD).isNull())
        rows = rows.drop(BAD_RECORD)
    if DATE_TEXT in tidied.columns:
        bad = _bad_date()
        if on_bad_date == "fail":
            message = F.concat(F.lit("not a date: "), F.col(DATE_TEXT))
            rows = rows.withColumn("date", F.when(bad, F.raise_error(message).cast("date")).otherwise(F.col("date")))
        elif extraction_date is not None and no_date_filter:
            rows = rows.where(~bad)
        rows = rows.drop(DATE_TEXT)
    # The other filters below drop rows without a date by themselves.
    if extraction_date is None:
        rows = rows.where(F.col("date").isNotNull())
        day, month = F.trunc("date", "month"), month_of(F.col("date"))
    else:
        if not no_date_filter:
            rows = rows.where(in_month(F.col("date"), month_key(extraction_date)))
        day, month = F.lit(extraction_date), F.lit(month_key(extraction_date))
    return rows.withColumns({"extraction_date": day.cast("date"), "extraction_month": month})


def prepare(spark: SparkSession, path: str | Sequence[str], extraction_date: date | None, *,
            no_date_filter: bool = False, on_bad_date: str = "reject") -> DataFrame:
    """Load, tidy and stamp a booking file."""
    return stamp(tidy(read_raw(spark, path)), extraction_date,
                 no_date_filter=no_date_filter, on_bad_date=on_bad_date)
