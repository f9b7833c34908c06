"""Records over several lines and ragged ones, up to the stored rejects."""

import os
from datetime import date

import pytest
import ride_file
from conftest import rows_of

from kerbside.plans import jobs
from kerbside.sources.ride_csv import has_records_over_lines, prepare, read_raw
from kerbside.sources.warehouse import Warehouse
from kerbside.streaming.incremental import ingest

MARCH = date(2024, 3, 15)


def write(folder, records, name="rides.csv"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join([ride_file.HEADER, *records]) + "\n")
    return f"{folder}/{name}"


def case(booking, **changes):
    fields = dict(zip(("day", "time", "booking", "status", "customer", "vehicle", "pickup", "drop"), ride_file.CASES[0], strict=False))
    fields |= {"booking": booking} | changes
    return ride_file.line((*fields.values(), *ride_file.CASES[0][8:]))


WHOLE = case("B1", pickup='"North,\nupper ""gate"""')
SHORT = ",".join(case("B2").split(",")[:8])
LONG = case("B3") + ",one,more"
LONG_OVER_LINES = case("B4", pickup='"West\nside"') + ",more"
PLAIN = case("B5")


def test_records_over_lines_are_one_row(spark, folder):
    path = write(folder, [WHOLE, SHORT, PLAIN])
    assert has_records_over_lines(spark, path) and not has_records_over_lines(spark, write(folder, [SHORT, PLAIN], "plain.csv"))
    rows = prepare(spark, path, MARCH)
    assert rows_of(rows, "booking_id", "pickup_location", "payment_method") == [
        ("B1", "North,\nupper gate", "UPI"), ("B2", "North", None), ("B5", "North", "UPI")]


@pytest.mark.parametrize("records", [[LONG, PLAIN], [LONG, LONG_OVER_LINES, WHOLE, PLAIN]])
def test_long_records_are_rejected_with_their_text(spark, folder, records):
    path, warehouse = write(folder, records), Warehouse(spark, f"{folder}/w")
    jobs.load_file(warehouse, path, MARCH)
    stored = {r[0] for r in rows_of(warehouse.read("bronze", "booking"), "booking_id")}
    assert stored == {"B1", "B5"} & {r.split(",")[2] for r in records}
    rejects = spark.read.parquet(f"{warehouse.root}/rejects/2024-03")
    assert rows_of(rejects, "reason", "_bad_record") == sorted(("fields", r) for r in records if r.endswith("more"))
    with pytest.raises(ValueError, match="too many fields: .*one,more"):
        jobs.load_file(Warehouse(spark, f"{folder}/other"), write(folder, [LONG], "long.csv"), MARCH, on_bad_date="fail")


def test_files_of_one_name_keep_their_own_rejects(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    bad = ride_file.line(ride_file.CASES[-1])
    jobs.load_file(warehouse, write(f"{folder}/a b", [PLAIN, bad]), None)
    jobs.load_file(warehouse, write(f"{folder}/c", [case("B6")]), None)
    rejects = spark.read.parquet(f"{warehouse.root}/rejects/all-months")
    assert rows_of(rejects, "booking_id", "source_file") == [("CNR8", "rides.csv")]
    jobs.load_file(warehouse, write(f"{folder}/a b", [PLAIN]), None)
    assert not [n for n in os.listdir(f"{warehouse.root}/rejects/all-months") if n.startswith("source_path=")]


def test_streams_keep_records_whole(spark, folder):
    write(f"{folder}/in", [WHOLE, LONG, SHORT])
    ingest(spark, f"{folder}/in", f"{folder}/w", f"{folder}/progress")
    warehouse = Warehouse(spark, f"{folder}/w")
    assert rows_of(warehouse.read("bronze", "booking"), "booking_id") == [("B1",), ("B2",)]
    assert spark.read.parquet(f"{warehouse.root}/rejects/followed").count() == 1


def test_fields_are_counted_outside_of_quotes(spark, folder):
    raw = read_raw(spark, write(folder, [case("B1", pickup='"a,b,c"'), case("B2") + ',"x,y"']))
    assert rows_of(raw.where("_bad_record is null"), "Booking ID") == [("B1",)]
