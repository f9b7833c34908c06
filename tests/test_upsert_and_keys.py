"""Stored upserts that rewrite the months they touch, and surrogate ids that stay."""

import os
from datetime import date, datetime

import pytest
import ride_file
from conftest import plan_of, rows_of
from pyspark.sql import functions as F

from kerbside.operators.stable_id import new_ids
from kerbside.plans import jobs
from kerbside.sources.warehouse import Warehouse

RUN_TS = datetime(2024, 4, 2)
COLUMNS = ["booking_id", "booking_value", "extraction_month"]


def month_files(warehouse):
    root = warehouse.path("bronze", "booking")
    return {m: sorted(os.listdir(f"{root}/extraction_month={m}")) for m in warehouse.stored_months("booking")}


@pytest.fixture
def stored(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w", key_filters=["booking_id"])
    rows = [(f"B{m}-{i}", float(i), f"2024-{m:02d}") for m in range(1, 6) for i in range(40)]
    warehouse.create("bronze", "booking")
    warehouse.append(spark.createDataFrame(rows, "booking_id string, booking_value double, extraction_month string"), "bronze", "booking")
    return warehouse


def updates(spark, rows):
    return spark.createDataFrame(rows, "booking_id string, booking_value double, extraction_month string")


@pytest.mark.parametrize("n", [3, 30])
def test_untouched_months_keep_their_files(spark, stored, n):
    """A key of another month moves; a new key comes; few keys and many."""
    before, rows = month_files(stored), rows_of(stored.read("bronze", "booking", COLUMNS))
    more = [("B2-7", 99.0, "2024-04"), ("B2-7", 98.0, "2024-03"), ("N1", 1.0, "2024-04"), *[(f"B4-{i}", -1.0, "2024-04") for i in range(n)]]
    stored.upsert(updates(spark, more), "bronze", "booking", ["booking_id"], [F.desc("extraction_month")])
    after = month_files(stored)
    assert {m for m in before if before[m] != after[m]} == {"2024-02", "2024-04"}
    gone = {"B2-7", *[f"B4-{i}" for i in range(n)]}
    expected = [r for r in rows if r[0] not in gone] + [more[0], *more[2:]]
    assert rows_of(stored.read("bronze", "booking", COLUMNS)) == sorted(expected, key=str)
    assert not os.listdir(f"{stored.root}/_writing")


def test_updates_of_no_month_are_refused_and_change_nothing(spark, stored):
    before = month_files(stored)
    with pytest.raises(ValueError, match="extraction_month"):
        stored.upsert(updates(spark, [("B1-1", 1.0, None)]), "bronze", "booking", ["booking_id"], ["booking_value"])
    stored.upsert(updates(spark, []), "bronze", "booking", ["booking_id"], ["booking_value"])
    assert month_files(stored) == before


def test_few_keys_reach_the_scan(spark, stored):
    plan = plan_of(stored.read("bronze", "booking", ["booking_id", "extraction_month"]).where(F.col("booking_id").isin(["B1-1", "B2-1"])))
    assert "PushedFilters: [In(booking_id" in plan and "ReadSchema: struct<booking_id:string>" in plan


def test_ids_stay_with_their_names(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")

    def ids():
        return dict(rows_of(warehouse.read("silver", "location"), "name", "location_id"))

    first = ride_file.write(folder, [c for c in ride_file.CASES if c[2] in ("CNR1", "CNR7")])
    jobs.incremental(spark, warehouse.root, first, date(2024, 4, 1), stable_ids=True, run_ts=RUN_TS)
    old = ids()
    jobs.incremental(spark, warehouse.root, ride_file.write(folder), date(2024, 3, 1), run_ts=RUN_TS)
    new = ids()
    assert old == {"East": 1, "Harbour": 2}
    assert {n: i for n, i in new.items() if n in old} == old
    assert [n for n, i in sorted(new.items(), key=lambda x: x[1])][2:] == sorted(set(new) - set(old))
    jobs.backfill(spark, warehouse.root, run_ts=RUN_TS)
    assert ids() == new
    facts = warehouse.read("silver", "booking").where("booking_id = 'CNR7'")
    assert rows_of(facts, "pickup_location_id", "drop_location_id") == [(1, 2)]


def test_new_ids_pass_over_nulls_and_repeats(spark):
    known = spark.createDataFrame([(4, "b"), (2, "x")], "k long, name string")
    names = spark.createDataFrame([("c",), ("a",), (None,), ("b",), ("a",)], "name string")
    assert rows_of(new_ids(names, known, "k")) == [(5, "a"), (6, "c")]
    assert new_ids(names.limit(0), known, "k").collect() == []
