"""The three layers over the sales star schema, stored on first use.

The read side works on stored tables, as it would in production: rebuilding
Bronze, Silver and Gold for every question would cost the whole load each
time.  Tables are written below the shared folder, once per application and
per version of the input files.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.settle import settle
from kerbside.plans import gold, partials, silver
from kerbside.plans.bronze import extract
from kerbside.schemas import TABLES
from kerbside.session import compile_in_pieces
from kerbside.sources.files import scratch_path, version_of
from kerbside.sources.ride_csv import REPEATED, stamp
from kerbside.sources.ride_star import ride_source
from kerbside.sources.warehouse import Warehouse, audit

RUN_TS = datetime(2024, 1, 1)
INPUTS = ["nation", "customer", "supplier", "part", "orders", "lineitem"]


class StarWarehouse:
    """Stored layers; every table is built from those below it when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        compile_in_pieces(spark)
        self.spark, self.sf_dir = spark, sf_dir
        self.store = Warehouse(spark, scratch_path(spark, "star"))
        self._built: set[tuple[str, str]] = set()
        self._prepared: DataFrame | None = None

    def prepared(self) -> DataFrame:
        """The booking rows, each stamped with the month of its date and stored by it; those that repeat are marked."""
        if self._prepared is None:
            self._prepared = settle(stamp(ride_source(self.spark, self.sf_dir, mark=True), None), "prepared")
        return self._prepared

    def extract(self, table: str) -> DataFrame:
        """One Bronze table of the booking rows, by month as they are; only marked ones are ranked."""
        return extract(table, self.prepared(), F.col(REPEATED))

    def _build(self, layer: str, table: str) -> None:
        if layer == "bronze":
            months = [r[0] for r in self.prepared().select("extraction_month").distinct().collect()]  # calendar months
            self.store.replace_months(self.extract(table), table, months, dealt=True)
            return
        if layer == "gold":
            rows = self._gold(table)
        elif table in silver.NAMED_DIMENSIONS:
            rows = silver.dimension(table, self.bronze(table))
        elif table == "customer":
            rows = silver.customer(self.bronze("booking"))
        elif table == "booking":
            rows = silver.booking(self.bronze("booking"), self.dimensions())
        else:
            rows = getattr(silver, table)(self.bronze(table))
        self.store.overwrite(audit(rows, RUN_TS), layer, table)

    def _gold(self, table: str) -> DataFrame:
        bookings = self.silver("booking")
        if table == "daily_booking_summary":
            return gold.daily_booking_summary(bookings, self.silver("vehicle_type"), self.silver("booking_status"))
        if table == "customer_analytics":
            return gold.customer_analytics(self.silver("customer"), bookings)
        return gold.location_analytics(bookings, self.silver("location"))

    def table(self, layer: str, table: str) -> DataFrame:
        if (layer, table) not in self._built:
            self._build(layer, table)
            self._built.add((layer, table))
        return self.store.read(layer, table)

    def bronze(self, table: str) -> DataFrame:
        return self.table("bronze", table)

    def silver(self, table: str) -> DataFrame:
        return self.table("silver", table)

    def gold(self, table: str) -> DataFrame:
        return self.table("gold", table)

    def partials(self, again: str) -> None:
        """Partial totals of all months; those of one month are emptied and renewed from its bookings alone."""
        if ("partials", again) not in self._built:
            self.bronze("booking")
            partials.refresh(self.store, [])
            for name in partials.PARTIALS:
                self.store.stage_months(self.store.read("partials", name).limit(0), name, "partials").put([again])
            partials.refresh(self.store, [again])
            self._built.add(("partials", again))

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self.silver(name) for name in silver.NAMED_DIMENSIONS}

    def layer(self, layer: str) -> dict[tuple[str, str], DataFrame]:
        return {(layer, table): self.table(layer, table) for table in TABLES[layer]}


_open: dict[tuple, StarWarehouse] = {}


def star_warehouse(spark: SparkSession, sf_dir: str) -> StarWarehouse:
    """The stored layers for these input files; changed files get new ones."""
    versions = tuple(version_of(spark, f"{sf_dir}/{name}.parquet") for name in INPUTS)
    key = (spark.sparkContext.applicationId, sf_dir, versions)
    if key not in _open:
        _open[key] = StarWarehouse(spark, sf_dir)
    return _open[key]
