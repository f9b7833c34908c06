"""Customers and Gold from month partials equal a full rebuild after every kind of load."""

import os
from datetime import date, datetime

import ride_file
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from kerbside.plans import jobs, partials
from kerbside.schemas import PARTIALS
from kerbside.sources.warehouse import Warehouse

MARCH, FEBRUARY = date(2024, 3, 15), date(2024, 2, 1)
RUN_TS = datetime(2024, 4, 2, 3, 4, 5)
TABLES = [("silver", "customer"), ("gold", "customer_analytics"), ("gold", "daily_booking_summary"), ("gold", "location_analytics")]


def state(warehouse):
    return {key: rows_of(warehouse.read(*key)) for key in TABLES}


def files_of(warehouse):
    return {(name, month): sorted(os.listdir(f"{warehouse.path('partials', name)}/extraction_month={month}"))
            for name in PARTIALS for month in warehouse.stored_months(name, "partials")}


def test_equal_to_a_rebuild_after_load_reload_and_emptied_month(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")

    def load(cases, day):
        jobs.incremental(spark, warehouse.root, ride_file.write(folder, cases), day, run_ts=RUN_TS)
        added_up = state(warehouse)
        jobs.backfill(spark, warehouse.root, run_ts=RUN_TS)
        assert added_up == state(warehouse)
        return added_up

    first = load(ride_file.CASES, FEBRUARY)
    both = load(ride_file.CASES, MARCH)
    kept = {key: files for key, files in files_of(warehouse).items() if key[1] == "2024-02"}
    changed = [(*c[:12], "7.25", *c[13:]) if c[2] == "CNR3" else c for c in ride_file.CASES]
    again = load(changed, MARCH)
    assert first != both != again
    load([c for c in ride_file.CASES if not c[0].startswith("2024-03")], MARCH)
    assert warehouse.stored_months("customer", "partials") == ["2024-02"]
    # The month before kept its very files throughout.
    assert kept == files_of(warehouse)


def test_a_renewed_month_reads_its_own_folder(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    jobs.load_file(warehouse, ride_file.write(folder), None)
    assert partials.refresh(warehouse, []) == ["2024-02", "2024-03", "2024-04"]
    assert partials.refresh(warehouse, ["2024-03"]) == ["2024-03"]
    rows = warehouse.read("bronze", "booking", where=F.col("extraction_month").isin(["2024-03"]))
    plan = plan_of(partials.partial("daily", rows))
    assert "PartitionFilters: [isnotnull(extraction_month" in plan or "(extraction_month" in plan.split("PartitionFilters")[1][:80]
    built = plan_of(partials.built("customer_analytics", warehouse))
    assert "bronze" not in built


def test_customers_of_a_month_travel_once(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    jobs.load_file(warehouse, ride_file.write(folder), None)
    rows = warehouse.read("bronze", "booking")
    plan = plan_of(partials.partial("customer", rows))
    assert plan.count("Exchange") == 1 and "REPARTITION" in plan
    partials.refresh(warehouse, [])
    assert rows_of(warehouse.read("partials", "customer")) == rows_of(
        partials.partial("customer", rows).select(warehouse.read("partials", "customer").columns))


def test_no_bookings(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    assert partials.refresh(warehouse, ["2024-03"]) == ["2024-03"]
    assert partials.built("customer", warehouse).collect() == []
