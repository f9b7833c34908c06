"""Documented analyses over Gold and Silver."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.calendar import in_month, month_of
from kerbside.functions.money import money_sum, percent
from kerbside.operators.bitmaps import bitmaps, common_to, n_ids, union_of


def previous_month_value(value: str, month: str) -> Column:
    """The value of the calendar month before; null across a gap.

    Used on one row per month only: at most 12 rows a year, so the unpartitioned
    window holds a few thousand rows whatever the size of the data.
    """
    by_month = Window.orderBy(month)
    adjacent = F.lag(month).over(by_month) == F.add_months(month, -1)
    return F.when(adjacent, F.lag(value).over(by_month))


def mom_growth(bronze_booking: DataFrame) -> DataFrame:
    """Bookings per extraction month and their growth in percent over the month before."""
    per_month = (
        bronze_booking.where(F.col("extraction_month").isNotNull()).groupBy("extraction_month")
        .agg(F.count("booking_id").alias("bookings"))
        .withColumn("first_day", F.to_date(F.concat("extraction_month", F.lit("-01"))))
    )
    with_previous = per_month.withColumn("previous_bookings", previous_month_value("bookings", "first_day"))
    return with_previous.select(
        "extraction_month", "bookings", "previous_bookings",
        percent(F.col("bookings") - F.col("previous_bookings"), F.col("previous_bookings").cast("double"))
        .alias("growth_percent"))


def first_booking_cohort(customer_analytics: DataFrame, month: str | None = None) -> DataFrame:
    """Customers by the month of their first booking, or the customers of one such month."""
    if month is not None:
        return customer_analytics.where(in_month(F.col("first_booking_date"), month))
    return (
        customer_analytics.where(F.col("first_booking_date").isNotNull())
        .groupBy(month_of(F.col("first_booking_date")).alias("cohort_month"))
        .agg(F.count("customer_id").alias("customers"), F.sum("total_bookings").alias("total_bookings"),
             money_sum(F.col("total_spent")).alias("total_spent"))
    )


def daily_revenue(daily_summary: DataFrame, month: str) -> DataFrame:
    return (
        daily_summary.where(in_month(F.col("date"), month)).groupBy("date")
        .agg(money_sum(F.col("total_revenue")).alias("total_revenue")).orderBy("date")
    )


def peak_hours(silver_booking: DataFrame) -> DataFrame:
    """Bookings per hour of the day."""
    hour = F.substring("time", 1, 2).try_cast("bigint")
    return (
        silver_booking.select(hour.alias("hour"), "booking_id").where(F.col("hour").isNotNull())
        .groupBy("hour").agg(F.count(F.lit(1)).alias("bookings")).orderBy("hour")
    )


def revenue_share(daily_summary: DataFrame) -> DataFrame:
    """Revenue and its share in percent by vehicle type."""
    by_vehicle = (
        daily_summary.where(F.col("vehicle_type_name").isNotNull()).groupBy("vehicle_type_name")
        .agg(money_sum(F.col("total_revenue")).alias("total_revenue"))
    )
    # One row: the grand total, a scalar to the rows of every vehicle type.
    total = by_vehicle.agg(money_sum(F.col("total_revenue")).alias("all_revenue"))
    return by_vehicle.withColumn("share_percent", percent(F.col("total_revenue"), total.scalar()))


def bookings_per_month(silver_booking: DataFrame) -> DataFrame:
    """Bookings per calendar month of the booking date."""
    return (
        silver_booking.where(F.col("date").isNotNull())
        .groupBy(F.trunc("date", "month").alias("first_day"))
        .agg(F.count("booking_id").alias("bookings"))
        .select(month_of(F.col("first_day")).alias("month"), "bookings").orderBy("month")
    )


def customer_bitmaps(bronze_booking: DataFrame, customers: DataFrame) -> DataFrame:
    """(month, bucket, bits): the customers of every month; ``customers`` (customer_id, id) numbers them densely."""
    rows = bronze_booking.where(F.col("customer_id").isNotNull()).select("customer_id", F.col("extraction_month").alias("month"))
    return bitmaps(rows.distinct().join(customers, "customer_id"), "id", ["month"])


def retention_between(monthly: DataFrame, spans: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """For (first month, last month) of two spans each: customers of the first, of the second, of both, and their share.

    Only bitmaps are read and merged, whatever the spans; the bookings are not touched again.
    """
    def line(a: str, b: str, c: str, d: str) -> DataFrame:
        early, late = (union_of(monthly.where(F.col("month").between(lo, hi))) for lo, hi in ((a, b), (c, d)))
        counted = n_ids(early).withColumnRenamed("n", "customers").withColumns({
            "later_customers": n_ids(late).scalar(), "came_back": n_ids(common_to(early, late)).scalar()})
        return counted.select(F.lit(f"{a}..{b}").alias("span"), F.lit(f"{c}..{d}").alias("later_span"), "*",
                              percent(F.col("came_back").cast("double"), F.col("customers").cast("double")).alias("retention_percent"))

    return reduce(DataFrame.unionByName, [line(*span) for span in spans])
