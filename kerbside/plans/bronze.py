"""Bronze: nine extracts of the prepared booking frame."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.keep_first import keep_first
from kerbside.schemas import LINEAGE_COLUMNS, schema_of
from kerbside.sources.ride_csv import REPEATED, order_columns


@dataclass(frozen=True)
class Extract:
    """One table: its columns by source column, the rows it takes, its de-duplication key."""

    columns: dict[str, str]
    keys: list[str]
    where: str
    zero_filled: list[str] = field(default_factory=list)

    @property
    def key_columns(self) -> list[str]:
        return [*self.keys, "extraction_month"]


# Columns, keys and row filters of the nine tables.
EXTRACTS: dict[str, Extract] = {
    "customer": Extract(
        {"customer_id": "customer_id", "booking_id": "booking_id"},
        ["customer_id", "booking_id"], "customer_id is not null"),
    "vehicle_type": Extract(
        {"vehicle_type_name": "vehicle_type", "booking_id": "booking_id"},
        ["vehicle_type_name", "booking_id"], "vehicle_type_name is not null"),
    "location": Extract(
        {"location_name": "location_name", "location_type": "location_type", "booking_id": "booking_id"},
        ["location_name", "location_type", "booking_id"], "location_name is not null"),
    "booking_status": Extract(
        {"booking_status_name": "booking_status", "booking_id": "booking_id"},
        ["booking_status_name", "booking_id"], "booking_status_name is not null"),
    "payment_method": Extract(
        {"payment_method_name": "payment_method", "booking_id": "booking_id"},
        ["payment_method_name", "booking_id"], "payment_method_name is not null"),
    "booking": Extract(
        {c: c for c in ("booking_id", "customer_id", "vehicle_type", "pickup_location", "drop_location",
                        "booking_status", "payment_method", "booking_value", "date", "time")},
        ["booking_id"], "booking_id is not null"),
    "ride": Extract(
        {c: c for c in ("booking_id", "ride_distance", "driver_rating", "customer_rating")},
        ["booking_id"], "booking_status = 'Completed' and booking_id is not null"),
    "cancelled_ride": Extract(
        {c: c for c in ("booking_id", "cancelled_rides_by_customer", "cancelled_rides_by_driver")},
        ["booking_id"], "cancelled_rides_by_customer is not null or cancelled_rides_by_driver is not null",
        ["cancelled_rides_by_customer", "cancelled_rides_by_driver"]),
    "incompleted_ride": Extract(
        {c: c for c in ("booking_id", "incomplete_rides", "incomplete_rides_reason")},
        ["booking_id"], "incomplete_rides is not null", ["incomplete_rides"]),
}


def _pickups_and_drops(prepared: DataFrame) -> DataFrame:
    """Two rows per booking, one for each end, out of a single scan."""
    ends = F.array(
        F.struct(F.col("pickup_location").alias("location_name"), F.lit("pickup").alias("location_type")),
        F.struct(F.col("drop_location").alias("location_name"), F.lit("drop").alias("location_type")))
    return prepared.select("booking_id", *LINEAGE_COLUMNS, *order_columns(prepared), *_mark(prepared), F.inline(ends))


def candidates(name: str, prepared: DataFrame) -> DataFrame:
    """The rows one table takes, renamed, before de-duplication."""
    spec = EXTRACTS[name]
    rows = _pickups_and_drops(prepared) if name == "location" else prepared
    renamed = rows.withColumns({new: F.col(old) for new, old in spec.columns.items() if new != old})
    return renamed.where(spec.where).select(*spec.columns, *LINEAGE_COLUMNS, *order_columns(prepared), *_mark(prepared))


def _mark(prepared: DataFrame) -> list[str]:
    return [REPEATED] if REPEATED in prepared.columns else []


def _booking_key() -> Column:
    return F.xxhash64("booking_id", "extraction_month")


def repeated_bookings(prepared: DataFrame) -> DataFrame:
    """(booking_key): hashes of the booking id and month that more than one row has, as all rows without an id.

    Every key of a Bronze table has both in it, so a row whose hash is not here is the only one of its key.  Equal
    hashes of different bookings do no harm: their rows are compared.
    """
    return prepared.groupBy(_booking_key().alias("booking_key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("booking_key")


def extract(name: str, prepared: DataFrame, repeated: DataFrame | Column | None = None) -> DataFrame:
    """One Bronze table: rows taken, first row per key kept, typed.

    Rows the source does not put in order are ordered by their own values, so
    the survivor never depends on the run.  With the stored ``repeated_bookings``,
    or a column that marks their rows, only these are shuffled and ranked; all
    others stay where they are.
    """
    spec = EXTRACTS[name]
    rows = candidates(name, prepared)

    def first(some: DataFrame) -> DataFrame:
        return keep_first(some, spec.key_columns, [*order_columns(prepared), *spec.columns, *LINEAGE_COLUMNS])

    if repeated is None:
        kept = first(rows)
    else:
        if isinstance(repeated, Column):
            alone, some = rows.where(~repeated), rows.where(repeated)
        else:
            same = _booking_key() == F.col("booking_key")
            alone, some = (rows.join(repeated, same, how) for how in ("left_anti", "left_semi"))
        # The few that were ranked are dealt by month again, for the writer.
        kept = alone.unionByName(first(some).hint("rebalance", "extraction_month"))
    zeros = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in spec.zero_filled}
    return kept.withColumns(zeros).select(*schema_of("bronze", name).fieldNames())
