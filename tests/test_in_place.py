"""Rows picked out of stored files without moving them."""

import os
import random
import re

import pytest
from conftest import SF_DIR, plan_of, rows_of
from pyspark.sql import functions as F

from kerbside.operators import in_place
from kerbside.operators.in_place import at_places, bitmaps, keep_first_in_place, placed
from kerbside.operators.keep_first import keep_first
from kerbside.plans import registry
from kerbside.plans.star_warehouse import star_warehouse
from kerbside.sources.warehouse import Warehouse

SCHEMA = "booking_id string, booking_value double, date date, extraction_month string"
MOVED = re.compile(r"(?<!Broadcast)Exchange|Rebalance", re.IGNORECASE)


@pytest.fixture
def stored(spark, folder):
    """Hot and null keys, rows that come twice, in several files by month."""
    draw = random.Random(5)
    rows = [(draw.choice([None, "hot", "hot", f"B{draw.randrange(40)}"]), float(i % 9), None, f"2024-{1 + i % 4:02d}") for i in range(400)]
    df = spark.createDataFrame([*rows, *rows[:50]], SCHEMA).repartition(3)
    df.write.partitionBy("extraction_month").parquet(f"{folder}/rows")
    return spark.read.schema(SCHEMA).parquet(f"{folder}/rows")


def test_the_first_row_of_every_key_is_found_in_its_place(stored):
    order = [F.desc("extraction_month"), "booking_value"]
    got = keep_first_in_place(stored.where("booking_value < 8"), ["booking_id"], order)
    assert not MOVED.search(plan_of(got))
    assert rows_of(got) == rows_of(keep_first(stored.where("booking_value < 8"), ["booking_id"], order))


@pytest.mark.parametrize("most", [0, 1000])
def test_chosen_rows_and_the_others_make_up_all(stored, most, monkeypatch):
    """Also with more bitmaps than are broadcast."""
    monkeypatch.setattr(in_place, "BROADCAST_BLOCKS", most)
    bits = bitmaps(placed(stored).where("booking_value = 3 or booking_id is null").select("_file", "_at"))
    chosen, others = at_places(stored, bits), at_places(stored, bits, chosen=False)
    assert rows_of(chosen) == rows_of(stored.where("booking_value = 3 or booking_id is null"))
    assert rows_of(chosen.unionByName(others)) == rows_of(stored)


def test_places_beyond_one_bitmap(spark, folder):
    n = in_place.BLOCK_ROWS * 2 + 77
    spark.range(0, n, 1, 1).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    bits = bitmaps(placed(rows).where("id % 5 = 2").select("_file", "_at"))
    assert at_places(rows, bits).agg(F.count("*"), F.sum("id")).first() == rows.where("id % 5 = 2").agg(F.count("*"), F.sum("id")).first()


def test_stored_upserts_move_no_row(spark, monkeypatch):
    """What the writer gets was shuffled neither for its rank, nor for the merge, nor for the writer."""
    layers = star_warehouse(spark, SF_DIR)
    layers.bronze("booking")
    plans, store = [], Warehouse._store

    def watched(self, df, path, *args, **kwargs):
        plans.append(plan_of(df.hint("rebalance", "extraction_month") if kwargs.get("by_month") and not kwargs.get("dealt") else df))
        return store(self, df, path, *args, **kwargs)

    monkeypatch.setattr(Warehouse, "_store", watched)
    rows = registry.store_upsert_months(layers)
    full = [p for p in plans if "FileScan" in p]
    assert len(full) == 3 and not any(MOVED.search(p) for p in full)
    assert rows.count() == rows.select("booking_id").distinct().count() > 0


@pytest.mark.parametrize("dealt", [False, True])
@pytest.mark.parametrize("there", ["absent", "empty"])
def test_upsert_into_nothing(spark, folder, there, dealt):
    warehouse = Warehouse(spark, f"{folder}/w")
    if there == "empty":
        warehouse.create("bronze", "booking")
    updates = spark.createDataFrame([("a", 1.0, None, "2024-01"), ("a", 2.0, None, "2024-02"), (None, 3.0, None, "2024-02")], SCHEMA)
    assert warehouse.upsert(updates, "bronze", "booking", ["booking_id"], [F.desc("extraction_month")], dealt=dealt) == 2
    got = warehouse.read("bronze", "booking", ["booking_id", "booking_value", "extraction_month"])
    assert rows_of(got) == sorted([("a", 2.0, "2024-02"), (None, 3.0, "2024-02")], key=str)
    assert not os.listdir(f"{warehouse.root}/_writing")


@pytest.mark.parametrize("dealt", [False, True])
def test_upsert_of_hot_and_null_keys(spark, folder, stored, dealt):
    """Against the operator over whole rows: stored keys that come twice stay or go together."""
    warehouse = Warehouse(spark, f"{folder}/w")
    warehouse.create("bronze", "booking")
    warehouse.append(stored.where("extraction_month < '2024-03'"), "bronze", "booking")
    before = warehouse.read("bronze", "booking").collect()
    updates = [("hot", 5.5, None, "2024-04"), ("hot", 6.5, None, "2024-05"), (None, 7.5, None, "2024-03"), ("B3", 8.5, None, "2024-01")]
    warehouse.upsert(spark.createDataFrame(updates, SCHEMA), "bronze", "booking", ["booking_id"], [F.desc("extraction_month")], dealt=dealt)
    got = warehouse.read("bronze", "booking", ["booking_id", "booking_value", "extraction_month"])
    left = [(r.booking_id, r.booking_value, r.extraction_month) for r in before if r.booking_id not in ("hot", None, "B3")]
    assert rows_of(got) == sorted([*left, ("hot", 6.5, "2024-05"), (None, 7.5, "2024-03"), ("B3", 8.5, "2024-01")], key=str)
