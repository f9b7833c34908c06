"""Checks run after a month has been loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.calendar import in_month
from kerbside.functions.money import money_sum, ratio
from kerbside.functions.nulls import all_present
from kerbside.plans.dashboard import top
from kerbside.sources.warehouse import Warehouse


def partition_count(bronze_booking: DataFrame, month: str) -> DataFrame:
    rows = bronze_booking.where(F.col("extraction_month") == month)
    return rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(month).alias("extraction_month"), "rows")


def date_range(bronze_booking: DataFrame, month: str) -> DataFrame:
    """Bookings dated in the month, first and last date; one row."""
    rows = bronze_booking.where(in_month(F.col("date"), month))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def cardinalities(customer: DataFrame, vehicle_type: DataFrame, location: DataFrame) -> DataFrame:
    sizes = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dimension"), "rows")
             for name, df in (("customer", customer), ("vehicle_type", vehicle_type), ("location", location))]
    return reduce(DataFrame.unionByName, sizes)


def vehicle_ids(vehicle_type: DataFrame) -> DataFrame:
    return vehicle_type.select("name", "vehicle_type_id").orderBy("name")


def month_totals(daily_summary: DataFrame, month: str) -> DataFrame:
    """Revenue, bookings, revenue per booking and summary rows of one month."""
    totals = daily_summary.where(in_month(F.col("date"), month)).agg(
        F.count(F.lit(1)).alias("summary_rows"),
        money_sum(F.col("total_revenue")).alias("total_revenue"),
        F.coalesce(F.sum("total_bookings"), F.lit(0)).alias("total_bookings"))
    return totals.select("summary_rows", "total_revenue", "total_bookings",
                         ratio(F.col("total_revenue"), F.col("total_bookings")).alias("avg_booking_value"))


def top_vehicle_revenue(daily_summary: DataFrame, month: str, k: int = 5) -> DataFrame:
    by_vehicle = (
        daily_summary.where(in_month(F.col("date"), month)).where(all_present("vehicle_type_name"))
        .groupBy("vehicle_type_name").agg(money_sum(F.col("total_revenue")).alias("total_revenue"))
    )
    return top(by_vehicle, "total_revenue", "vehicle_type_name", k)


def top_spenders(customer_analytics: DataFrame, k: int = 10) -> DataFrame:
    return top(customer_analytics, "total_spent", "customer_id", k).select(
        "customer_id", "total_bookings", "total_spent", "avg_booking_value")


def top_locations(location_analytics: DataFrame, k: int = 10) -> DataFrame:
    return top(location_analytics, "total_activity", "name", k).select(
        "name", "pickups", "dropoffs", "total_activity")


def partition_summary(bronze_booking: DataFrame, month: str) -> DataFrame:
    """Rows per loaded month, the checked month marked."""
    counted = bronze_booking.where(F.col("extraction_month").isNotNull()).groupBy("extraction_month").agg(
        F.count(F.lit(1)).alias("rows"))
    return counted.withColumn("is_current", F.col("extraction_month") == month).orderBy("extraction_month")


def verify(warehouse: Warehouse, month: str) -> dict[str, DataFrame]:
    """All checks for one month as lazy frames by name."""
    bookings = warehouse.read("bronze", "booking")
    vehicles = warehouse.read("silver", "vehicle_type")
    daily = warehouse.read("gold", "daily_booking_summary")
    customers = warehouse.read("gold", "customer_analytics")
    locations = warehouse.read("gold", "location_analytics")
    return {
        "partition_count": partition_count(bookings, month),
        "date_range": date_range(bookings, month),
        "cardinalities": cardinalities(
            warehouse.read("silver", "customer"), vehicles, warehouse.read("silver", "location")),
        "vehicle_ids": vehicle_ids(vehicles),
        "month_totals": month_totals(daily, month),
        "top_vehicle_revenue": top_vehicle_revenue(daily, month),
        "top_spenders": top_spenders(customers),
        "top_locations": top_locations(locations),
        "partition_summary": partition_summary(bookings, month),
    }
