"""Table profiles: size, columns, descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.quantiles import exact_quantiles

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def table_size(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count"))


def _unstack(wide: DataFrame, names: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per profiled column out of a one-row frame with ``<i>_<statistic>`` columns."""
    rows = F.array(*[
        F.struct(F.lit(name).alias("column_name"), *[F.col(f"c{i}_{c}").alias(c) for c in columns])
        for i, name in enumerate(names)
    ])
    return wide.select(F.inline(rows))


def column_profile(df: DataFrame) -> DataFrame:
    """Name, Spark type, non-null and null count of every column, in one scan."""
    aggregates = []
    for i, field in enumerate(df.schema.fields):
        filled = F.count(F.col(field.name))
        aggregates += [
            F.lit(field.dataType.simpleString()).alias(f"c{i}_data_type"),
            filled.alias(f"c{i}_non_null_count"),
            (F.count(F.lit(1)) - filled).alias(f"c{i}_null_count"),
        ]
    return _unstack(df.agg(*aggregates), df.columns, ["data_type", "non_null_count", "null_count"])


def _as_number(field: T.StructField):
    """Numbers as they are; dates in days, timestamps in seconds since 1970-01-01."""
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(field.name).cast("double")
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(field.name).cast("timestamp")).cast("double") / 1e6
    return F.col(field.name).cast("double")


def describable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))]


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max of numeric and date columns.

    Quartiles are exact, linearly interpolated and computed without bringing a
    column into one task (see ``exact_quantiles``).
    """
    names = list(columns or describable(df))
    numbers = df.select(*[_as_number(df.schema[name]).alias(name) for name in names])
    aggregates = []
    for i, name in enumerate(names):
        c = F.col(name)
        aggregates += [
            F.count(c).alias(f"c{i}_count"), F.avg(c).alias(f"c{i}_mean"), F.stddev_samp(c).alias(f"c{i}_std"),
            F.min(c).alias(f"c{i}_min"), F.max(c).alias(f"c{i}_max"),
        ]
    basic = _unstack(numbers.agg(*aggregates), names, ["count", "mean", "std", "min", "max"])
    quartiles = exact_quantiles(numbers, names, QUARTILES)
    return basic.join(quartiles, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *QUARTILES, "max")
