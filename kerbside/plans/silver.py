"""Silver: five dimensions and four facts, rebuilt from all Bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.dense_id import dense_id
from kerbside.operators.keep_first import keep_first
from kerbside.operators.lookup import lookup
from kerbside.plans.bronze import EXTRACTS
from kerbside.sources.ride_csv import order_columns

# Dimension -> (its name column in Bronze, its id column).
NAMED_DIMENSIONS = {
    "vehicle_type": ("vehicle_type_name", "vehicle_type_id"),
    "location": ("location_name", "location_id"),
    "booking_status": ("booking_status_name", "booking_status_id"),
    "payment_method": ("payment_method_name", "payment_method_id"),
}

# Booking column -> (dimension, id column in the fact).
BOOKING_LOOKUPS = {
    "vehicle_type": ("vehicle_type", "vehicle_type_id"),
    "pickup_location": ("location", "pickup_location_id"),
    "drop_location": ("location", "drop_location_id"),
    "booking_status": ("booking_status", "booking_status_id"),
    "payment_method": ("payment_method", "payment_method_id"),
}


def only_month(bronze: DataFrame, extraction_month: str | None) -> DataFrame:
    """Bronze rows of one month, or all of them: the reference state of Silver."""
    return bronze if extraction_month is None else bronze.where(F.col("extraction_month") == extraction_month)


def customer(bronze_booking: DataFrame) -> DataFrame:
    """First and last day seen and number of bookings; bookings without a customer drop out."""
    return (
        bronze_booking.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("date").alias("first_seen_date"), F.max("date").alias("last_seen_date"),
             F.count("booking_id").alias("total_bookings"))
    )


def dimension(name: str, bronze: DataFrame) -> DataFrame:
    """Distinct names with ids 1..N in name order, so ids are the same on every run.

    Only names matter, so rows repeated by key may be in ``bronze`` or not.
    """
    key = NAMED_DIMENSIONS[name][1]
    return dense_id(names_of(name, bronze), key, ["name"]).select(key, "name")


def names_of(name: str, bronze: DataFrame) -> DataFrame:
    """Distinct names of a dimension."""
    return bronze.select(F.col(NAMED_DIMENSIONS[name][0]).alias("name")).where(F.col("name").isNotNull()).distinct()


def booking(bronze_booking: DataFrame, dimensions: dict[str, DataFrame], *, carry_month: bool = False) -> DataFrame:
    """Names replaced by dimension ids; an unknown or missing name gives a null id."""
    fact = bronze_booking
    for column, (name, out) in BOOKING_LOOKUPS.items():
        fact = lookup(fact, column, dimensions[name], "name", NAMED_DIMENSIONS[name][1], out)
    ids = [out for _, out in BOOKING_LOOKUPS.values()]
    month = ["extraction_month"] if carry_month else []
    return fact.select("booking_id", "customer_id", *ids, "booking_value", "date", "time", *month)


def ride(bronze_ride: DataFrame) -> DataFrame:
    """Completed rides; ``ride_id`` is declared but never filled."""
    return bronze_ride.select("booking_id", "ride_distance", "driver_rating", "customer_rating")


def cancelled_ride(bronze_cancelled: DataFrame) -> DataFrame:
    rows = bronze_cancelled.select("booking_id", "cancelled_rides_by_customer", "cancelled_rides_by_driver",
                                   "extraction_month")
    order = ["booking_id", "extraction_month", "cancelled_rides_by_customer", "cancelled_rides_by_driver"]
    return dense_id(rows, "cancellation_id", order).drop("extraction_month")


def incompleted_ride(bronze_incompleted: DataFrame) -> DataFrame:
    rows = bronze_incompleted.select("booking_id", "incomplete_rides", "incomplete_rides_reason", "extraction_month")
    order = ["booking_id", "extraction_month", "incomplete_rides", "incomplete_rides_reason"]
    return dense_id(rows, "incompleted_id", order).drop("extraction_month")


def ride_times(prepared: DataFrame) -> DataFrame:
    """The ride fact with arrival and trip minutes, as the data dictionary lists it."""
    columns = ["booking_id", "avg_vtat", "avg_ctat", "ride_distance", "driver_rating", "customer_rating"]
    return _first_bookings("ride", prepared, columns)


def cancellation_actor(prepared: DataFrame) -> DataFrame:
    """Who cancelled and why: one actor and one reason per cancellation.

    The customer flag wins if both are set; the reason is the customer's if
    there is one, else the driver's.
    """
    actor = (F.when(F.col("cancelled_rides_by_customer") > 0, "Customer")
             .when(F.col("cancelled_rides_by_driver") > 0, "Driver"))
    named = prepared.withColumns({
        "ride_cancelled_by": actor,
        "cancellation_reason": F.coalesce("customer_cancel_reason", "driver_cancel_reason")})
    return _first_bookings("cancelled_ride", named, ["booking_id", "ride_cancelled_by", "cancellation_reason"])


def _first_bookings(table: str, prepared: DataFrame, columns: list[str]) -> DataFrame:
    """Other columns of the rows a Bronze table takes, de-duplicated as that table is."""
    spec, order = EXTRACTS[table], order_columns(prepared)
    rows = prepared.where(spec.where).select(*columns, "extraction_month", *order)
    return keep_first(rows, spec.key_columns, [*order, *columns]).select(*columns)
