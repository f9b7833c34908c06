"""The customer dimension and Gold from stored partial totals of the bookings by month.

Counts, exact sums, minima and maxima of a month are stored once.  A load changes the partials of its own months and
no others, and what is built from them reads a row per key and month instead of all bookings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions.money import avg_of_parts, merged_parts, money_parts, sum_of_parts
from kerbside.functions.nulls import all_present
from kerbside.operators.spread import SLICE, deal
from kerbside.schemas import PARTIALS
from kerbside.sources.warehouse import MONTH, StagedMonths, Warehouse

LAYER = "partials"


def _by_month(bookings: DataFrame) -> DataFrame:
    """Bookings dealt by month, a large month over several tasks by customer, as the writer wants the totals.

    Nearly every booking of a month has a customer of its own, so totals by customer and month are no fewer and
    wider than the bookings: these travel once, and are added up where they lie.
    """
    rows = [n for _, n in bookings.groupBy(MONTH).agg(F.count(F.lit(1))).collect()]  # a number per calendar month
    return deal(bookings, MONTH, F.col("customer_id"), rows)


def partial(name: str, bookings: DataFrame) -> DataFrame:
    """Totals of Bronze bookings by month and key; rows without a key have no part in what is built from them."""
    amounts = money_parts(F.col("booking_value"))
    if name == "customer":
        known = bookings.select("customer_id", "booking_id", "date", "booking_value", MONTH).where(all_present("customer_id"))
        # A number tells as much of the booking as its id, which only counts.
        dealt = _by_month(known.withColumn("booking_id", F.when(F.col("booking_id").isNotNull(), F.lit(1))))
        return dealt.groupBy("customer_id", MONTH, SLICE).agg(
            F.count("booking_id").alias("n_bookings"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
            *_named(amounts)).drop(SLICE)
    if name == "daily":
        keys = ["date", "vehicle_type", "booking_status"]
        return bookings.where(all_present(*keys)).groupBy(*keys, MONTH).agg(F.count("booking_id").alias("n_bookings"), *_named(amounts))
    ends = F.array(
        F.struct(F.col("pickup_location").alias("location"), F.lit(True).alias("is_pickup"), "booking_value"),
        F.struct(F.col("drop_location").alias("location"), F.lit(False).alias("is_pickup"), F.lit(None).cast("double").alias("booking_value")))
    return bookings.select("booking_id", MONTH, F.inline(ends)).where(all_present("location")).groupBy("location", MONTH).agg(
        F.count(F.when(F.col("is_pickup"), F.lit(1))).alias("pickup_rows"),
        F.count(F.when(F.col("is_pickup"), F.col("booking_id"))).alias("pickups"),
        F.count(F.when(~F.col("is_pickup"), F.col("booking_id"))).alias("dropoffs"), *_named(amounts))


def _named(aggregates: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in aggregates.items()]


def refresh(warehouse: Warehouse, months: Sequence[str]) -> list[str]:
    """Renew the partials of the given months from their Bronze folders; the months renewed.

    Stored months without partials are added, so the first refresh of a warehouse brings all of them.  A month that
    Bronze has no row of any more loses its partials.
    """
    missing = set(warehouse.stored_months("booking")) - set(warehouse.stored_months("customer", LAYER))
    renewed = sorted(set(months) | missing)
    bookings = warehouse.read("bronze", "booking", where=F.col(MONTH).isin(renewed))
    staged: list[StagedMonths] = []
    try:
        staged += [warehouse.stage_months(partial(name, bookings), name, LAYER, dealt=name == "customer") for name in PARTIALS]
    except Exception:
        for rows in staged:
            rows.discard()
        raise
    for rows in staged:
        rows.put(renewed)
    return renewed


def customer(customers: DataFrame) -> DataFrame:
    """The customer dimension from its partials."""
    return customers.groupBy("customer_id").agg(
        F.min("first_date").alias("first_seen_date"), F.max("last_date").alias("last_seen_date"), F.sum("n_bookings").alias("total_bookings"))


def customer_analytics(people: DataFrame, customers: DataFrame) -> DataFrame:
    """Spend, booking dates and lifetime in days per customer, from the dimension and the partials."""
    parts = merged_parts()
    stats = customers.groupBy("customer_id").agg(
        F.sum("n_bookings").alias("total_bookings"), sum_of_parts(parts).alias("total_spent"), avg_of_parts(parts).alias("avg_booking_value"),
        F.min("first_date").alias("first_booking_date"), F.max("last_date").alias("last_booking_date"))
    lifetime = F.datediff("last_booking_date", "first_booking_date").cast("bigint")
    return people.select("customer_id", "first_seen_date", "last_seen_date").join(stats, "customer_id", "left").withColumn(
        "customer_lifetime_days", lifetime)


def daily_booking_summary(days: DataFrame, vehicle_type: DataFrame, booking_status: DataFrame) -> DataFrame:
    """Bookings and revenue per day, vehicle type and status; names that the dimensions lack drop out."""
    parts = merged_parts()
    totals = days.groupBy("date", "vehicle_type", "booking_status").agg(
        F.sum("n_bookings").alias("total_bookings"), sum_of_parts(parts).alias("total_revenue"), avg_of_parts(parts).alias("avg_booking_value"))
    vehicles = vehicle_type.select(F.col("name").alias("vehicle_type"))
    statuses = booking_status.select(F.col("name").alias("booking_status"))
    return totals.join(vehicles, "vehicle_type", "left_semi").join(statuses, "booking_status", "left_semi").withColumnsRenamed(
        {"vehicle_type": "vehicle_type_name", "booking_status": "booking_status_name"})


def location_analytics(places: DataFrame, location: DataFrame) -> DataFrame:
    """Pickups, drop-offs, activity and mean pickup value per location of the dimension."""
    activity = places.groupBy(F.col("location").alias("name")).agg(
        F.sum("pickups").alias("pickups"), F.sum("dropoffs").alias("dropoffs"), avg_of_parts(merged_parts()).alias("avg_booking_value"))
    filled = {c: F.coalesce(F.col(c), F.lit(0)).cast(kind) for c, kind in
              (("pickups", "bigint"), ("dropoffs", "bigint"), ("avg_booking_value", "double"))}
    return location.select("location_id", "name").join(activity, "name", "left").withColumns(filled).withColumn(
        "total_activity", F.col("pickups") + F.col("dropoffs"))


def built(name: str, warehouse: Warehouse) -> DataFrame:
    """A table from the stored partials and dimensions: customer, or one of Gold."""
    def stored(table: str) -> DataFrame:
        return warehouse.read("silver", table)

    if name == "customer":
        return customer(warehouse.read(LAYER, "customer"))
    if name == "customer_analytics":
        return customer_analytics(stored("customer"), warehouse.read(LAYER, "customer"))
    if name == "daily_booking_summary":
        return daily_booking_summary(warehouse.read(LAYER, "daily"), stored("vehicle_type"), stored("booking_status"))
    return location_analytics(warehouse.read(LAYER, "location"), stored("location"))
