"""Declared schemas of the source file and of the 21 stored tables."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T

LAYERS = ("bronze", "silver", "gold")

LINEAGE = "extraction_date DATE, extraction_month STRING, source_file STRING"
AUDIT = "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
LINEAGE_COLUMNS = ["extraction_date", "extraction_month", "source_file"]
AUDIT_COLUMNS = ["created_at", "updated_at"]

# Table and column names, in stored order.
TABLES: dict[str, dict[str, str]] = {
    "bronze": {
        "customer": f"customer_id STRING, booking_id STRING, {LINEAGE}",
        "vehicle_type": f"vehicle_type_name STRING, booking_id STRING, {LINEAGE}",
        "location": f"location_name STRING, location_type STRING, booking_id STRING, {LINEAGE}",
        "booking_status": f"booking_status_name STRING, booking_id STRING, {LINEAGE}",
        "payment_method": f"payment_method_name STRING, booking_id STRING, {LINEAGE}",
        "booking": "booking_id STRING, customer_id STRING, vehicle_type STRING, pickup_location STRING, "
                   "drop_location STRING, booking_status STRING, payment_method STRING, "
                   f"booking_value DOUBLE, date DATE, time STRING, {LINEAGE}",
        "ride": "booking_id STRING, ride_distance DOUBLE, driver_rating DOUBLE, customer_rating DOUBLE, "
                f"{LINEAGE}",
        "cancelled_ride": "booking_id STRING, cancelled_rides_by_customer BIGINT, "
                          f"cancelled_rides_by_driver BIGINT, {LINEAGE}",
        "incompleted_ride": "booking_id STRING, incomplete_rides BIGINT, incomplete_rides_reason STRING, "
                            f"{LINEAGE}",
    },
    "silver": {
        "customer": f"customer_id STRING, first_seen_date DATE, last_seen_date DATE, total_bookings BIGINT, {AUDIT}",
        "vehicle_type": f"vehicle_type_id BIGINT, name STRING, {AUDIT}",
        "location": f"location_id BIGINT, name STRING, {AUDIT}",
        "booking_status": f"booking_status_id BIGINT, name STRING, {AUDIT}",
        "payment_method": f"payment_method_id BIGINT, name STRING, {AUDIT}",
        "booking": "booking_id STRING, customer_id STRING, vehicle_type_id BIGINT, pickup_location_id BIGINT, "
                   "drop_location_id BIGINT, booking_status_id BIGINT, payment_method_id BIGINT, "
                   f"booking_value DOUBLE, date DATE, time STRING, {AUDIT}",
        "ride": "ride_id BIGINT, booking_id STRING, ride_distance DOUBLE, driver_rating DOUBLE, "
                f"customer_rating DOUBLE, {AUDIT}",
        "cancelled_ride": "cancellation_id BIGINT, booking_id STRING, cancelled_rides_by_customer BIGINT, "
                          f"cancelled_rides_by_driver BIGINT, {AUDIT}",
        "incompleted_ride": "incompleted_id BIGINT, booking_id STRING, incomplete_rides BIGINT, "
                            f"incomplete_rides_reason STRING, {AUDIT}",
    },
    "gold": {
        "daily_booking_summary": "date DATE, vehicle_type_name STRING, booking_status_name STRING, "
                                 "total_bookings BIGINT, total_revenue DOUBLE, avg_booking_value DOUBLE, "
                                 f"extraction_month STRING, {AUDIT}",
        "customer_analytics": "customer_id STRING, first_seen_date DATE, last_seen_date DATE, "
                              "total_bookings BIGINT, total_spent DOUBLE, avg_booking_value DOUBLE, "
                              "first_booking_date DATE, last_booking_date DATE, customer_lifetime_days BIGINT, "
                              f"extraction_month STRING, {AUDIT}",
        "location_analytics": "location_id BIGINT, name STRING, pickups BIGINT, dropoffs BIGINT, "
                              "avg_booking_value DOUBLE, total_activity BIGINT, extraction_month STRING, "
                              f"{AUDIT}",
    },
}

_SUMS = "n_values BIGINT, high BIGINT, low BIGINT, other DOUBLE, extraction_month STRING"

#: Stored beside the layers: totals of the bookings by month, which add up to the customer dimension and to Gold.
PARTIALS: dict[str, str] = {
    "customer": f"customer_id STRING, n_bookings BIGINT, first_date DATE, last_date DATE, {_SUMS}",
    "daily": f"date DATE, vehicle_type STRING, booking_status STRING, n_bookings BIGINT, {_SUMS}",
    "location": f"location STRING, pickup_rows BIGINT, pickups BIGINT, dropoffs BIGINT, {_SUMS}",
}

# Header of the source file, our column name, target type.
SOURCE_COLUMNS: list[tuple[str, str, str]] = [
    ("Date", "date", "date"),
    ("Time", "time", "string"),
    ("Booking ID", "booking_id", "string"),
    ("Booking Status", "booking_status", "string"),
    ("Customer ID", "customer_id", "string"),
    ("Vehicle Type", "vehicle_type", "string"),
    ("Pickup Location", "pickup_location", "string"),
    ("Drop Location", "drop_location", "string"),
    ("Avg VTAT", "avg_vtat", "double"),
    ("Avg CTAT", "avg_ctat", "double"),
    ("Cancelled Rides by Customer", "cancelled_rides_by_customer", "double"),
    ("Reason for cancelling by Customer", "customer_cancel_reason", "string"),
    ("Cancelled Rides by Driver", "cancelled_rides_by_driver", "double"),
    ("Driver Cancellation Reason", "driver_cancel_reason", "string"),
    ("Incomplete Rides", "incomplete_rides", "double"),
    ("Incomplete Rides Reason", "incomplete_rides_reason", "string"),
    ("Booking Value", "booking_value", "double"),
    ("Ride Distance", "ride_distance", "double"),
    ("Driver Ratings", "driver_rating", "double"),
    ("Customer Rating", "customer_rating", "double"),
    ("Payment Method", "payment_method", "string"),
]

# A source file may lack these: no stored table is built from them.
OPTIONAL_SOURCE_COLUMNS = {"avg_vtat", "avg_ctat", "customer_cancel_reason", "driver_cancel_reason"}


@cache
def schema_of(layer: str, table: str) -> T.StructType:
    """The declared schema of one stored table; every field is nullable."""
    return T.StructType.fromDDL(PARTIALS[table] if layer == "partials" else TABLES[layer][table])


def all_tables() -> list[tuple[str, str]]:
    return [(layer, table) for layer in LAYERS for table in TABLES[layer]]


def view_name(layer: str, table: str) -> str:
    return f"{layer}_{table}"
