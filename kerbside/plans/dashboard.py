"""The data behind the dashboard: month filters, KPIs, trends, top lists."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.money import money_sum, ratio
from kerbside.functions.nulls import all_present
from kerbside.sources.warehouse import Warehouse

ALL_MONTHS = "All"
log = logging.getLogger(__name__)


def available_months(warehouse: Warehouse) -> DataFrame:
    """Months of stored bookings, newest first; from the folder names alone."""
    months = sorted(warehouse.stored_months("booking"), reverse=True)
    return warehouse.spark.createDataFrame([(m,) for m in months], "extraction_month string")


def filter_direct(df: DataFrame, month: str) -> DataFrame:
    return df.where(F.col("extraction_month") == month)


def filter_by_key(df: DataFrame, bronze_booking: DataFrame, month: str, key: str) -> DataFrame:
    """Rows whose key occurs in that month's bookings.

    The semi-join reads one column of one month partition.  Its right side
    cannot be split at a frequent key, so every key goes there once.
    """
    keys = filter_direct(bronze_booking, month).select(key).distinct()
    return df.join(keys, key, "left_semi")


def filter_by_location_name(df: DataFrame, bronze_booking: DataFrame, month: str) -> DataFrame:
    """Rows whose ``name`` was picked up from or dropped at in that month."""
    names = (
        filter_direct(bronze_booking, month)
        .select(F.explode(F.array("pickup_location", "drop_location")).alias("name"))
        .where(F.col("name").isNotNull()).distinct()
    )
    return df.join(names, "name", "left_semi")


def filter_month(df: DataFrame, layer: str, table: str, month: str, bronze_booking: DataFrame) -> DataFrame:
    """Choose how a table is limited to a month; unfiltered, with a warning, if it cannot be.

    Totals of a filtered customer stay all-time: the filter picks customers,
    it does not recompute them.
    """
    if month == ALL_MONTHS:
        return df
    columns = set(df.columns)
    # Gold declares the month but leaves it null, so it is no filter there.
    if "extraction_month" in columns and layer != "gold":
        return filter_direct(df, month)
    if "booking_id" in columns:
        return filter_by_key(df, bronze_booking, month, "booking_id")
    if (layer, table) == ("gold", "customer_analytics"):
        return filter_by_key(df, bronze_booking, month, "customer_id")
    if (layer, table) == ("gold", "location_analytics") and "location_id" not in columns and "name" in columns:
        return filter_by_location_name(df, bronze_booking, month)
    if (layer, table) == ("gold", "daily_booking_summary"):
        return recalc_daily_summary(bronze_booking, month)
    log.warning("%s.%s has no link to a month: all rows are used", layer, table)
    return df


def recalc_daily_summary(bronze_booking: DataFrame, month: str) -> DataFrame:
    """The daily summary of one month straight from Bronze.

    Its average is revenue per booking, not the mean of the paid bookings.
    """
    keys = ["date", "vehicle_type", "booking_status"]
    return (
        filter_direct(bronze_booking, month).where(all_present(*keys)).groupBy(*keys)
        .agg(F.count("booking_id").alias("total_bookings"), money_sum(F.col("booking_value")).alias("total_revenue"))
        .select("date", F.col("vehicle_type").alias("vehicle_type_name"),
                F.col("booking_status").alias("booking_status_name"), "total_bookings", "total_revenue",
                ratio(F.col("total_revenue"), F.col("total_bookings")).alias("avg_booking_value"))
    )


def kpis(daily_summary: DataFrame) -> DataFrame:
    """One row: bookings, revenue, revenue per booking, number of days."""
    totals = daily_summary.agg(
        F.coalesce(F.sum("total_bookings"), F.lit(0)).alias("total_bookings"),
        money_sum(F.col("total_revenue")).alias("total_revenue"),
        F.countDistinct("date").alias("unique_dates"))
    return totals.select("total_bookings", "total_revenue",
                         ratio(F.col("total_revenue"), F.col("total_bookings")).alias("avg_booking_value"),
                         "unique_dates")


def total_by(daily_summary: DataFrame, key: str, measure: str) -> DataFrame:
    """A summed measure by one key of the daily summary."""
    total = money_sum(F.col(measure)) if measure == "total_revenue" else F.sum(measure)
    return daily_summary.where(F.col(key).isNotNull()).groupBy(key).agg(total.alias(measure))


def daily_trend(daily_summary: DataFrame) -> DataFrame:
    return total_by(daily_summary, "date", "total_bookings")


def daily_revenue(daily_summary: DataFrame) -> DataFrame:
    return total_by(daily_summary, "date", "total_revenue")


def status_breakdown(daily_summary: DataFrame) -> DataFrame:
    return total_by(daily_summary, "booking_status_name", "total_bookings")


def vehicle_breakdown(daily_summary: DataFrame) -> DataFrame:
    return total_by(daily_summary, "vehicle_type_name", "total_bookings")


def top(df: DataFrame, measure: str, tie_break: str, k: int) -> DataFrame:
    """The k largest rows; ties are settled by a key, nulls come last."""
    return df.orderBy(F.desc_nulls_last(measure), F.asc(tie_break)).limit(k)


def top_customers(customer_analytics: DataFrame, k: int = 10) -> DataFrame:
    return top(customer_analytics, "total_bookings", "customer_id", k).select(
        "customer_id", "total_bookings", "total_spent")


def top_locations(location_analytics: DataFrame, k: int = 10) -> DataFrame:
    return top(location_analytics, "total_activity", "name", k).select(
        "name", "pickups", "dropoffs", "total_activity")
