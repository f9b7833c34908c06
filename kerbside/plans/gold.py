"""Gold: three aggregates over the Silver star schema.

Facts are aggregated by id first and meet the dimensions afterwards, so no
join touches a fact row and a hot id is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.money import money_avg, money_sum
from kerbside.functions.nulls import all_present

MONTH = "extraction_month"


def daily_booking_summary(booking: DataFrame, vehicle_type: DataFrame, booking_status: DataFrame, *,
                          by_month: bool = False, target_date=None) -> DataFrame:
    """Bookings and revenue per day, vehicle type and status; incomplete keys drop out.

    ``target_date`` limits the result to one day (off by default).
    """
    month = [MONTH] if by_month else []
    keys = ["date", "vehicle_type_id", "booking_status_id", *month]
    rows = booking if target_date is None else booking.where(F.col("date") == F.lit(target_date))
    by_id = (
        rows.where(all_present(*keys)).groupBy(*keys)
        .agg(F.count("booking_id").alias("total_bookings"),
             money_sum(F.col("booking_value")).alias("total_revenue"),
             money_avg(F.col("booking_value")).alias("avg_booking_value"))
    )
    vehicles = vehicle_type.select("vehicle_type_id", F.col("name").alias("vehicle_type_name"))
    statuses = booking_status.select("booking_status_id", F.col("name").alias("booking_status_name"))
    return by_id.join(vehicles, "vehicle_type_id").join(statuses, "booking_status_id").select(
        "date", "vehicle_type_name", "booking_status_name",
        "total_bookings", "total_revenue", "avg_booking_value", *month)


def customer_analytics(customer: DataFrame, booking: DataFrame, *, by_month: bool = False) -> DataFrame:
    """Spend, booking dates and lifetime in days per customer (and month)."""
    month = [MONTH] if by_month else []
    stats = (
        booking.where(all_present("customer_id", *month)).groupBy("customer_id", *month)
        .agg(F.count("booking_id").alias("total_bookings"),
             money_sum(F.col("booking_value")).alias("total_spent"),
             money_avg(F.col("booking_value")).alias("avg_booking_value"),
             F.min("date").alias("first_booking_date"), F.max("date").alias("last_booking_date"))
    )
    lifetime = F.datediff("last_booking_date", "first_booking_date").cast("bigint")
    return (
        customer.select("customer_id", "first_seen_date", "last_seen_date")
        .join(stats, "customer_id", "left")
        .select("customer_id", "first_seen_date", "last_seen_date", "total_bookings", "total_spent",
                "avg_booking_value", "first_booking_date", "last_booking_date",
                lifetime.alias("customer_lifetime_days"), *month)
    )


def location_analytics(booking: DataFrame, location: DataFrame, *, by_month: bool = False,
                       keep_drop_only: bool = False) -> DataFrame:
    """Pickups, drop-offs, activity and mean pickup value per location (and month).

    Both ends of a booking are counted in one scan.  By month, the pickups fix
    which (location, month) pairs appear; ``keep_drop_only`` also keeps pairs
    that only have drop-offs.
    """
    month = [MONTH] if by_month else []
    ends = F.array(
        F.struct(F.col("pickup_location_id").alias("location_id"), F.lit(True).alias("is_pickup"),
                 F.col("booking_value").alias("pickup_value")),
        F.struct(F.col("drop_location_id").alias("location_id"), F.lit(False).alias("is_pickup"),
                 F.lit(None).cast("double").alias("pickup_value")))
    activity = (
        booking.select("booking_id", *month, F.inline(ends))
        .where(all_present("location_id", *month)).groupBy("location_id", *month)
        .agg(F.count(F.when(F.col("is_pickup"), F.lit(1))).alias("pickup_rows"),
             F.count(F.when(F.col("is_pickup"), F.col("booking_id"))).alias("pickups"),
             F.count(F.when(~F.col("is_pickup"), F.col("booking_id"))).alias("dropoffs"),
             money_avg(F.col("pickup_value")).alias("avg_booking_value"))
    )
    if by_month and not keep_drop_only:
        activity = activity.where(F.col("pickup_rows") > 0)
    filled = {c: F.coalesce(F.col(c), F.lit(0)).cast(kind) for c, kind in
              (("pickups", "bigint"), ("dropoffs", "bigint"), ("avg_booking_value", "double"))}
    return (
        location.select("location_id", "name").join(activity, "location_id", "left").withColumns(filled)
        .select("location_id", "name", "pickups", "dropoffs", "avg_booking_value",
                (F.col("pickups") + F.col("dropoffs")).alias("total_activity"), *month)
    )
