"""From an untidy file to the stored layers."""

from datetime import date, datetime
from pathlib import Path

import pytest
import ride_file
from conftest import rows_of
from pyspark.sql import functions as F

from kerbside import cli
from kerbside.plans import dashboard, jobs, sql_views
from kerbside.plans.verification import verify
from kerbside.schemas import LAYERS, TABLES, schema_of
from kerbside.sources.ride_csv import prepare, read_raw
from kerbside.sources.warehouse import Warehouse
from kerbside.streaming.incremental import ingest, ingest_and_refresh

MARCH = date(2024, 3, 15)
RUN_TS = datetime(2024, 4, 2, 3, 4, 5)


@pytest.fixture(scope="module")
def march(spark, tmp_path_factory):
    """All layers for March."""
    folder = str(tmp_path_factory.mktemp("march"))
    counts = jobs.run(spark, f"{folder}/w", ride_file.write(folder), MARCH, run_ts=RUN_TS)
    return Warehouse(spark, f"{folder}/w"), counts


def snapshot(warehouse, *skip):
    return {(layer, t): rows_of(warehouse.read(layer, t).drop(*skip)) for layer in LAYERS for t in TABLES[layer]}


def test_header_names_are_trimmed(spark, folder):
    assert read_raw(spark, ride_file.write(folder)).columns[0] == "Date"


def test_month_slice_bounds(spark, folder):
    path = ride_file.write(folder)
    days = prepare(spark, path, MARCH).agg(F.min("date"), F.max("date")).first()
    assert tuple(days) == (date(2024, 3, 1), date(2024, 3, 31))
    everything = prepare(spark, path, MARCH, no_date_filter=True)
    assert everything.count() == len(ride_file.CASES) - 1
    assert rows_of(everything.select("extraction_month").distinct()) == [("2024-03",)]


def test_a_bad_date_can_stop_the_run(spark, folder):
    path = ride_file.write(folder)
    with pytest.raises(Exception, match="not a date: 2024-13-01"):
        prepare(spark, path, MARCH, no_date_filter=True, on_bad_date="fail").collect()


def test_missing_column_is_named(spark, folder):
    path = f"{folder}/bad.csv"
    with open(path, "w") as out:
        out.write("Date,Time\n2024-03-01,08:00:00\n")
    with pytest.raises(ValueError, match="Booking ID"):
        prepare(spark, path, MARCH)


def test_bronze(march):
    warehouse, counts = march
    assert rows_of(warehouse.read("bronze", "booking"), "booking_id", "customer_id", "booking_status",
                   "booking_value") == [
        ("CNR1", "C1", "Completed", 100.25), ("CNR2", "C2", "Cancelled by Customer", None),
        ("CNR3", None, "Completed", 20.0), ("CNR5", "C5", "Incomplete", None)]
    # The ride filter comes before de-duplication, so the later completed row survives.
    assert rows_of(warehouse.read("bronze", "ride"), "booking_id", "ride_distance") == [
        ("CNR1", 5.5), ("CNR2", 2.0), ("CNR3", 1.0)]
    # Both customers of one booking are kept; the null id is kept once.
    assert rows_of(warehouse.read("bronze", "customer"), "customer_id", "booking_id") == [
        ("C1", "CNR1"), ("C2", "CNR2"), ("C3", "CNR2"), ("C4", None), ("C5", "CNR5")]
    assert rows_of(warehouse.read("bronze", "cancelled_ride", [
        "booking_id", "cancelled_rides_by_customer", "cancelled_rides_by_driver"])) == [("CNR2", 1, 0), (None, 0, 1)]
    assert rows_of(warehouse.read("bronze", "incompleted_ride", [
        "booking_id", "incomplete_rides", "incomplete_rides_reason"])) == [("CNR5", 1, "Breakdown")]
    assert rows_of(warehouse.read("bronze", "payment_method"), "payment_method_name", "booking_id") == [
        ("Cash", "CNR2"), ("UPI", "CNR1"), ("UPI", "CNR3")]
    locations = rows_of(warehouse.read("bronze", "location"), "location_name", "location_type", "booking_id")
    assert len(locations) == 9 and ("Island", "drop", "CNR5") in locations
    assert warehouse.read("bronze", "booking").first()["source_file"] == "rides.csv"
    assert counts["bronze"]["bronze.booking"] == 4


def test_silver(march):
    warehouse, counts = march
    assert rows_of(warehouse.read("silver", "customer").drop("created_at", "updated_at")) == [
        ("C1", date(2024, 3, 1), date(2024, 3, 1), 1), ("C2", date(2024, 3, 2), date(2024, 3, 2), 1),
        ("C5", date(2024, 3, 7), date(2024, 3, 7), 1)]
    assert rows_of(warehouse.read("silver", "location"), "location_id", "name") == [
        (1, "East"), (2, "Island"), (3, "North"), (4, "South"), (5, "West")]
    facts = rows_of(warehouse.read("silver", "booking"), "booking_id", "vehicle_type_id", "pickup_location_id",
                    "drop_location_id", "payment_method_id")
    assert facts == [("CNR1", 1, 3, 4, 2), ("CNR2", 2, 3, 1, None), ("CNR3", None, 5, None, 2),
                     ("CNR5", 1, 4, 2, None)]
    assert rows_of(warehouse.read("silver", "cancelled_ride"), "cancellation_id", "booking_id") == [
        (1, None), (2, "CNR2")]
    assert rows_of(warehouse.read("silver", "ride").select("ride_id").distinct()) == [(None,)]
    assert {r[0] for r in warehouse.read("silver", "booking").select("created_at").collect()} == {RUN_TS}
    assert counts["silver"]["silver.location"] == 5


def test_gold(march):
    warehouse, _ = march
    daily = rows_of(warehouse.read("gold", "daily_booking_summary").drop("created_at", "updated_at"))
    # The booking without a vehicle type drops out; a group without values has revenue 0 and no mean.
    assert daily == [
        (date(2024, 3, 1), "Auto", "Completed", 1, 100.25, 100.25, None),
        (date(2024, 3, 2), "Bike", "Cancelled by Customer", 1, 0.0, None, None),
        (date(2024, 3, 7), "Auto", "Incomplete", 1, 0.0, None, None)]
    people = rows_of(warehouse.read("gold", "customer_analytics"), "customer_id", "total_bookings", "total_spent",
                     "avg_booking_value", "customer_lifetime_days")
    assert people == [("C1", 1, 100.25, 100.25, 0), ("C2", 1, 0.0, None, 0), ("C5", 1, 0.0, None, 0)]
    places = rows_of(warehouse.read("gold", "location_analytics"), "name", "pickups", "dropoffs", "avg_booking_value",
                     "total_activity")
    assert places == [("East", 0, 1, 0.0, 1), ("Island", 0, 1, 0.0, 1), ("North", 2, 0, 100.25, 2),
                      ("South", 1, 1, 0.0, 2), ("West", 1, 0, 20.0, 1)]


def test_rejected_rows_are_kept(march):
    warehouse, _ = march
    rejects = warehouse.spark.read.parquet(f"{warehouse.root}/rejects/2024-03")
    assert rows_of(rejects, "booking_id", "_date_text") == [("CNR8", "2024-13-01")]


def test_stored_tables_have_the_declared_schema(march):
    warehouse, _ = march
    for layer, table in warehouse.tables():
        fields = [(f.name, f.dataType, f.nullable) for f in warehouse.read(layer, table).schema.fields]
        assert fields == [(f.name, f.dataType, True) for f in schema_of(layer, table).fields]


def test_repeating_a_month_changes_nothing(spark, folder):
    path = ride_file.write(folder)
    jobs.run(spark, f"{folder}/w", path, MARCH, run_ts=RUN_TS)
    warehouse = Warehouse(spark, f"{folder}/w")
    before = snapshot(warehouse)
    jobs.run(spark, f"{folder}/w", path, MARCH, run_ts=RUN_TS)
    assert snapshot(warehouse) == before
    # Appending stores the rows again, as asked; adding only new keys does not.
    counts = jobs.load_file(warehouse, path, MARCH, mode="add_new")
    assert set(counts.values()) == {0}
    jobs.load_file(warehouse, path, MARCH, mode="append")
    assert warehouse.read("bronze", "booking").count() == 8


def test_a_month_that_became_empty_is_emptied(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    jobs.load_file(warehouse, ride_file.write(folder), MARCH)
    february = [c for c in ride_file.CASES if c[0].startswith("2024-02")]
    jobs.run(spark, f"{folder}/w", ride_file.write(folder, february, "later.csv"), MARCH, run_ts=RUN_TS)
    assert all(rows == [] for rows in snapshot(warehouse).values())


def test_all_months_equal_single_months(spark, folder):
    path = ride_file.write(folder)
    jobs.run_all_months(spark, f"{folder}/once", path, run_ts=RUN_TS)
    for month in (2, 3, 4):
        jobs.run_month(spark, f"{folder}/each", path, 2024, month, run_silver=False, run_gold=False)
    jobs.backfill(spark, f"{folder}/each", run_ts=RUN_TS)
    once, each = Warehouse(spark, f"{folder}/once"), Warehouse(spark, f"{folder}/each")
    assert once.stored_months("booking") == ["2024-02", "2024-03", "2024-04"]
    assert snapshot(once) == snapshot(each)
    as_of = rows_of(once.as_of_month("booking", "2024-03"), "booking_id")
    assert ("CNR7",) not in as_of and ("CNR6",) in as_of


def test_arguments_are_checked(spark, folder):
    with pytest.raises(FileNotFoundError):
        jobs.run(spark, f"{folder}/w", f"{folder}/none.csv", MARCH)
    with pytest.raises(ValueError, match="month"):
        jobs.run_month(spark, folder, "x", 2024, 13)
    with pytest.raises(ValueError, match="day"):
        jobs.run_month(spark, folder, "x", 2024, 1, 32)
    with pytest.raises(ValueError, match="create it first"):
        Warehouse(spark, folder).append(spark.createDataFrame([], "booking_id string"), "bronze", "booking")


def test_store_modes(spark, folder):
    warehouse = Warehouse(spark, folder)
    assert warehouse.read("silver", "vehicle_type").count() == 0
    warehouse.create("silver", "vehicle_type")
    rows = spark.createDataFrame([(1, "Auto"), (2, "Bike")], "vehicle_type_id int, name string")
    assert warehouse.overwrite(rows, "silver", "vehicle_type") == 2
    warehouse.create("silver", "vehicle_type")  # does not drop what is stored
    nothing = rows.where("false")
    assert warehouse.overwrite(nothing, "silver", "vehicle_type", keep_on_empty=True) == 0
    assert warehouse.read("silver", "vehicle_type").count() == 2
    more = spark.createDataFrame([(2, "Moto"), (3, "Van")], "vehicle_type_id int, name string")
    assert warehouse.upsert(more, "silver", "vehicle_type", ["vehicle_type_id"], ["name"]) == 3
    assert rows_of(warehouse.read("silver", "vehicle_type"), "vehicle_type_id", "name") == [
        (1, "Auto"), (2, "Moto"), (3, "Van")]
    assert warehouse.overwrite(nothing, "silver", "vehicle_type") == 0
    assert warehouse.read("silver", "vehicle_type").count() == 0


def test_files_that_arrive_are_loaded_once(spark, folder, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    ride_file.write(inbox, ride_file.CASES[:5], "a.csv")
    target, progress = f"{folder}/w", f"{folder}/progress"
    ingest(spark, str(inbox), target, progress)
    warehouse = Warehouse(spark, target)
    assert rows_of(warehouse.read("bronze", "booking"), "booking_id") == [("CNR1",), ("CNR2",), ("CNR3",)]
    ride_file.write(inbox, ride_file.CASES[3:], "b.csv")
    ingest_and_refresh(spark, str(inbox), target, progress, run_ts=RUN_TS)
    # CNR2 arrived again with another customer: the stored row stays.
    stored = rows_of(warehouse.read("bronze", "booking"), "booking_id", "customer_id")
    assert stored == [("CNR1", "C1"), ("CNR2", "C2"), ("CNR3", None), ("CNR5", "C5"), ("CNR6", "C1"), ("CNR7", "C1")]
    assert warehouse.read("bronze", "cancelled_ride").where(F.col("booking_id").isNull()).count() == 1
    assert warehouse.read("gold", "customer_analytics").count() == 3
    # Losing the record of taken files repeats the batches: nothing is added.
    ingest(spark, str(inbox), target, f"{folder}/progress-again")
    assert rows_of(warehouse.read("bronze", "booking"), "booking_id", "customer_id") == stored


def test_ad_hoc_sql(march, folder):
    warehouse, _ = march
    spark = warehouse.spark
    names = sql_views.register_views(warehouse)
    assert len(names) == 21 and "gold_daily_booking_summary" in names
    result = sql_views.run_sql(spark, "SELECT count(*) AS n FROM silver_booking")
    assert (result.rows, result.columns, result.error) == (1, 1, None) and result.frame.first()["n"] == 4
    broken = sql_views.run_sql(spark, "SELECT nothing FROM nowhere")
    assert broken.frame is None and "nowhere" in broken.error
    failing = sql_views.run_sql(spark, "SELECT 1 / (booking_value - booking_value) FROM silver_booking")
    assert failing.frame is None and "DIVIDE_BY_ZERO" in failing.error
    twice = sql_views.run_sql(spark, "SELECT booking_id, booking_id, null FROM silver_booking ORDER BY booking_id DESC")
    assert twice.rows == 4 and twice.columns == 3 and [r[1] for r in twice.frame.collect()] == ["CNR5", "CNR3", "CNR2", "CNR1"]
    assert {r["view_name"] for r in sql_views.sample(spark, "list_gold").collect()} == {
        "gold_daily_booking_summary", "gold_customer_analytics", "gold_location_analytics"}
    listing = sql_views.table_listing({k: warehouse.read(*k) for k in warehouse.tables()})
    assert ("bronze", "booking", "bronze_booking", "bronze.booking", 4, 13) in rows_of(listing)
    assert ("date", "date", None) in rows_of(sql_views.describe_view(spark, "bronze_booking"))
    sql_views.export_csv(result.frame, f"{folder}/out")
    assert rows_of(spark.read.option("header", True).csv(f"{folder}/out")) == [("4",)]


def test_month_filter_picks_its_way(march):
    warehouse, _ = march
    bookings = warehouse.read("bronze", "booking")

    def size(layer, table, month, drop=()):
        return dashboard.filter_month(
            warehouse.read(layer, table).drop(*drop), layer, table, month, bookings).count()

    assert size("bronze", "ride", "2024-03") == 3 and size("bronze", "ride", "2024-04") == 0
    assert size("silver", "ride", "2024-03") == 3 and size("silver", "ride", "2024-04") == 0
    assert size("silver", "ride", dashboard.ALL_MONTHS) == 3
    assert size("gold", "customer_analytics", "2024-03") == 3 and size("gold", "customer_analytics", "2024-04") == 0
    assert size("gold", "location_analytics", "2024-04") == 5  # by id: cannot be filtered
    assert size("gold", "location_analytics", "2024-04", ["location_id"]) == 0
    assert size("gold", "daily_booking_summary", "2024-03") == 3
    assert size("silver", "vehicle_type", "2024-04") == 2


def test_verification(march):
    warehouse, _ = march
    frames = verify(warehouse, "2024-03")
    assert rows_of(frames["partition_count"]) == [("2024-03", 4)]
    assert rows_of(frames["date_range"]) == [(4, date(2024, 3, 1), date(2024, 3, 31))]
    assert rows_of(frames["month_totals"]) == [(3, 100.25, 3, 100.25 / 3)]
    assert rows_of(frames["partition_summary"]) == [("2024-03", 4, True)]
    empty = verify(warehouse, "2023-01")
    assert rows_of(empty["month_totals"]) == [(0, 0.0, 0, 0.0)]


def test_command_line(spark, folder):
    path = ride_file.write(folder)
    run = cli.parse_args(["run", "-s", path, "-w", f"{folder}/w", "-d", "2024-03-01"])
    assert set(cli.execute(run, spark)) == {"bronze", "silver", "gold"}
    silver = cli.execute(cli.parse_args(["silver", "-w", f"{folder}/w", "-m", "2024-02"]), spark)
    assert silver["silver"]["silver.booking"] == 0
    again = cli.execute(cli.parse_args(["backfill", "-w", f"{folder}/w"]), spark)
    assert again["silver"]["silver.booking"] == 4
    assert cli.execute(cli.parse_args(["verify", "-w", f"{folder}/w", "-m", "2024-03"]), spark) == {}
    months = cli.execute(cli.parse_args(["gold", "-w", f"{folder}/w", "--by-month"]), spark)
    assert months["gold"]["gold.daily_booking_summary"] == 3
    assert rows_of(Warehouse(spark, f"{folder}/w").read("gold", "customer_analytics").select("extraction_month").distinct()) == [("2024-03",)]
    one_day = cli.execute(cli.parse_args(["gold", "-w", f"{folder}/w", "-d", "2024-03-02"]), spark)
    assert one_day["gold"]["gold.daily_booking_summary"] == 1
    for wrong in (["bronze"], ["backfill", "--mode", "append"], ["all-months", "-s", "x", "--no-date-filter"], ["follow", "-s", "x", "--mode", "replace"]):
        with pytest.raises(SystemExit):
            cli.parse_args(wrong)


def test_verify_prints_every_month(spark, folder, capsys):
    months = [(f"{y}-{m:02d}-03", *ride_file.CASES[0][1:2], f"B{y}{m}", *ride_file.CASES[0][3:]) for y in range(2015, 2021) for m in range(1, 13)]
    jobs.run_all_months(spark, f"{folder}/w", ride_file.write(folder, months))
    cli.execute(cli.parse_args(["verify", "-w", f"{folder}/w", "-m", "2019-03"]), spark)
    printed = capsys.readouterr().out
    assert all(f"{y}-{m:02d}\t1\t" in printed for y in range(2015, 2021) for m in range(1, 13))


def test_months_without_rows_of_one_table_are_emptied(spark, folder):
    path = ride_file.write(folder)
    warehouse = Warehouse(spark, f"{folder}/w")
    for day in (MARCH, None):
        jobs.load_file(warehouse, path, day)
        assert warehouse.read("bronze", "cancelled_ride").count() == 2
        without = [c for c in ride_file.CASES if not (c[8] or c[9])]
        jobs.load_file(warehouse, ride_file.write(folder, without, "without.csv"), day)
        assert warehouse.read("bronze", "cancelled_ride").count() == 0
        assert warehouse.read("bronze", "ride").count() > 0


def test_a_bad_date_stops_before_any_write(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    jobs.load_file(warehouse, ride_file.write(folder), MARCH)
    before = snapshot(warehouse)
    more = ride_file.write(folder, [*ride_file.CASES, (*ride_file.CASES[0][:2], "CNR99", *ride_file.CASES[0][3:])], "more.csv")
    for options in ({"no_date_filter": True}, {"mode": "append"}, {}):
        with pytest.raises(ValueError, match="not a date: 2024-13-01"):
            jobs.load_file(warehouse, more, MARCH, on_bad_date="fail", **options)
        assert snapshot(warehouse) == before


def test_a_failed_write_leaves_what_was_stored(spark, folder, monkeypatch):
    warehouse = Warehouse(spark, folder)
    rows = spark.createDataFrame([(1, "Auto"), (2, "Bike")], "vehicle_type_id int, name string")
    warehouse.overwrite(rows, "silver", "vehicle_type")
    failing = rows.withColumn("name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        warehouse.overwrite(failing, "silver", "vehicle_type")
    with pytest.raises(Exception, match="broken"):
        warehouse.upsert(failing, "silver", "vehicle_type", ["vehicle_type_id"], ["name"])
    assert warehouse.read("silver", "vehicle_type").count() == 2
    jobs.load_file(warehouse, ride_file.write(folder), MARCH)
    before = snapshot(warehouse)

    def broken(name, prepared):
        good = real(name, prepared)
        return good.withColumn("booking_id", F.raise_error(F.lit("broken")).cast("string")) if name == "payment_method" else good

    real = jobs.extract
    monkeypatch.setattr(jobs, "extract", broken)
    with pytest.raises(Exception, match="broken"):
        jobs.load_file(warehouse, ride_file.write(folder, ride_file.CASES[:2], "few.csv"), MARCH)
    assert snapshot(warehouse) == before


def test_rejects_of_every_file_are_kept(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    bad = ride_file.CASES[-1]
    one = ride_file.write(folder, [*ride_file.CASES[:3], bad], "one.csv")
    two = ride_file.write(folder, [ride_file.CASES[4], (bad[0], bad[1], "CNR88", *bad[3:])], "two.csv")
    for path in (one, two, two):
        jobs.load_file(warehouse, path, MARCH, mode="add_new")
    rejects = spark.read.parquet(f"{warehouse.root}/rejects/2024-03")
    assert rows_of(rejects, "booking_id", "source_file") == [("CNR8", "one.csv"), ("CNR88", "two.csv")]


def test_rejects_of_a_corrected_file_go(spark, folder):
    """Also if no row of the month is left in it; those of other files stay."""
    warehouse = Warehouse(spark, f"{folder}/w")
    bad = ride_file.CASES[-1]
    names = ["one 1.csv", "two.csv", "three.csv"]
    for name in names:
        jobs.load_file(warehouse, ride_file.write(folder, [ride_file.CASES[0], bad], name), MARCH)
    for name, cases in (("one 1.csv", ride_file.CASES[:1]), ("two.csv", [("2024-07-02", *ride_file.CASES[0][1:])])):
        jobs.load_file(warehouse, ride_file.write(folder, cases, name), MARCH)
    rejects = spark.read.parquet(f"{warehouse.root}/rejects/2024-03")
    assert rows_of(rejects, "booking_id", "source_file") == [("CNR8", "three.csv")]


def test_several_files_folders_and_patterns(spark, folder, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    paths = [ride_file.write(inbox, ride_file.CASES[:3], "a.csv"), ride_file.write(inbox, ride_file.CASES[3:], "b.csv")]
    counts = [jobs.load_file(Warehouse(spark, f"{folder}/{i}"), source, None)
              for i, source in enumerate((paths, str(inbox), f"{inbox}/*.csv"))]
    assert counts[0] == counts[1] == counts[2] and counts[0]["bronze.booking"] == 6
    with pytest.raises(FileNotFoundError):
        jobs.load_file(Warehouse(spark, f"{folder}/x"), [paths[0], f"{inbox}/*.txt"], None)


def test_appends_write_few_files(spark, folder):
    warehouse = Warehouse(spark, f"{folder}/w")
    cases = [(f"2024-0{1 + i % 6}-02", ride_file.CASES[0][1], f"B{i}", *ride_file.CASES[0][3:]) for i in range(60)]
    jobs.load_file(warehouse, ride_file.write(folder, cases), None, mode="append", spread_to=12)
    written = list(Path(folder).glob("w/bronze/booking/*/*.parquet"))
    assert 6 <= len(written) <= 12
