"""Exact quantiles over tables of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.settle import settled


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    """One row per column, one field per probability, linearly interpolated.

    Spark's ``percentile`` keeps every distinct value of a group in one buffer.
    Instead values are counted first (a hot value becomes one row), the counts
    are range-partitioned and written with their slice number, slice totals
    give the slice each wanted rank falls into, and only those slices are read
    again and ranked.  Writing freezes the slices: a retry cannot move them.
    The result has a row per column, so it is taken to the driver and the
    written slices are removed.
    """
    value_counts = (
        df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])))
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    sliced = value_counts.repartitionByRange("column_name", "value").withColumn("slice", F.spark_partition_id())
    with settled(sliced, "quantiles") as slices:
        result = _from_slices(slices, probabilities)
        return df.sparkSession.createDataFrame(result.collect(), result.schema)


def _from_slices(slices: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    # One row per column and slice, so no more rows than write tasks plus columns.
    totals = slices.groupBy("column_name", "slice").agg(F.sum("n").alias("slice_n"))
    by_slice = Window.partitionBy("column_name").orderBy("slice")
    before = totals.select(
        "column_name", "slice", "slice_n",
        (F.sum("slice_n").over(by_slice) - F.col("slice_n")).alias("offset"),
        F.sum("slice_n").over(Window.partitionBy("column_name")).alias("total"))
    wanted = F.array(*[
        F.struct(F.lit(name).alias("quantile"), ((F.col("total") - 1) * F.lit(float(p))).alias("position"))
        for name, p in probabilities.items()])
    hits = (
        before.select("column_name", "slice", "slice_n", "offset", F.inline(wanted))
        .select("*", F.explode(F.array_distinct(F.array(
            F.floor("position"), F.ceil("position")))).alias("rank"))
        .where((F.col("rank") >= F.col("offset")) & (F.col("rank") < F.col("offset") + F.col("slice_n")))
        .select("column_name", "slice", "offset", "quantile", "position", "rank")
    )
    # Proven bound: at most two rows per column and probability.
    needed = hits.select("column_name", "slice", "offset").distinct()
    ranked = (
        slices.join(F.broadcast(needed), ["column_name", "slice"])
        .withColumn("upto", F.sum("n").over(Window.partitionBy("column_name", "slice").orderBy("value"))
                    + F.col("offset"))
    )
    picked = (
        ranked.join(F.broadcast(hits.drop("offset")), ["column_name", "slice"])
        .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        .groupBy("column_name", "quantile", "position")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumn("fraction", F.col("position") - F.floor("position"))
        .withColumn("result", F.col("low") * (1 - F.col("fraction")) + F.col("high") * F.col("fraction"))
    )
    return picked.groupBy("column_name").agg(*[
        F.max(F.when(F.col("quantile") == name, F.col("result"))).alias(name) for name in probabilities])
