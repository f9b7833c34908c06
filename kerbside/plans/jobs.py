"""Jobs: fill the layers from a booking file, and re-run them safely."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable, Sequence
from datetime import UTC, date, datetime
from functools import partial
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.calendar import in_month, month_key
from kerbside.operators.settle import settled
from kerbside.operators.stable_id import new_ids
from kerbside.plans import gold, partials, silver
from kerbside.plans.bronze import EXTRACTS, extract, repeated_bookings
from kerbside.sources.files import child_names, delete_tree, matches
from kerbside.sources.ride_csv import BAD_RECORD, DATE_TEXT, SOURCE_PATH, read_raw, rejected, stamp, tidy
from kerbside.sources.warehouse import StagedMonths, Warehouse, audit, together

Counts = dict[str, int]
log = logging.getLogger(__name__)


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def bronze_load(warehouse: Warehouse, prepared: DataFrame, *, month: str | None = None,
                mode: str = "replace") -> Counts:
    """Write the nine extracts of a prepared frame; rows written per table.

    ``prepared`` should be a stored table: it is read nine times, a few columns
    each.  Modes: "replace" swaps the month (or, without ``month``, every month
    in the frame) in all nine tables, also where an extract has no row for it,
    so loads can be repeated; "append" adds rows as they are; "add_new" adds only
    keys not stored yet.  In "replace" all extracts are written before the first
    one takes the place of stored rows.
    """
    def write(name: str) -> int:
        rows = extract(name, prepared, repeated)
        if mode == "append":
            warehouse.create("bronze", name)
            return warehouse.append(rows, "bronze", name)
        return warehouse.add_new(rows, name, EXTRACTS[name].key_columns, months)

    if mode not in ("replace", "append", "add_new"):
        raise ValueError(f"unknown mode: {mode}")
    # Calendar months: a short list, read from one column.
    months = [month] if month is not None else [
        r[0] for r in prepared.select("extraction_month").distinct().collect() if r[0] is not None]
    staged: dict[str, StagedMonths] = {}

    def stage(name: str) -> int:
        staged[name] = warehouse.stage_months(extract(name, prepared, repeated), name)
        return staged[name].rows

    with settled(repeated_bookings(prepared), "repeated") as repeated:
        if mode != "replace":
            return together(warehouse.spark, {f"bronze.{name}": partial(write, name) for name in EXTRACTS})
        try:
            counts = together(warehouse.spark, {f"bronze.{name}": partial(stage, name) for name in EXTRACTS})
        except Exception:
            for rows in staged.values():
                rows.discard()
            raise
        for rows in staged.values():
            rows.put(months)
        return counts


def silver_refresh(warehouse: Warehouse, *, run_ts: datetime | None = None,
                   extraction_month: str | None = None, from_partials: bool = False, stable_ids: bool = False) -> Counts:
    """Rebuild the dimensions, then the facts that look them up; ``from_partials`` adds customers up by month.

    With ``stable_ids``, and from then on, a name keeps the id it got first and new names are numbered on; otherwise
    ids follow name order.
    """
    run_ts = run_ts or utc_now()
    stable_ids = stable_ids or warehouse.has_key_maps()

    def bronze(table: str) -> DataFrame:
        return silver.only_month(warehouse.read("bronze", table), extraction_month)

    def write(table: str, build: Callable[[], DataFrame]) -> int:
        return warehouse.overwrite(audit(build(), run_ts), "silver", table)

    dimensions = {"customer": lambda: silver.customer(bronze("booking"))}
    if stable_ids:
        dimensions |= {name: partial(lambda n: _stable_dimension(warehouse, n, bronze(n)), name) for name in silver.NAMED_DIMENSIONS}
    if from_partials:
        dimensions["customer"] = lambda: partials.built("customer", warehouse)
    dimensions |= {name: partial(lambda n: silver.dimension(n, bronze(n)), name) for name in silver.NAMED_DIMENSIONS}
    counts = together(warehouse.spark, {f"silver.{t}": partial(write, t, build) for t, build in dimensions.items()})

    named = {name: warehouse.read("silver", name) for name in silver.NAMED_DIMENSIONS}
    facts = {
        "booking": lambda: silver.booking(bronze("booking"), named),
        "ride": lambda: silver.ride(bronze("ride")),
        "cancelled_ride": lambda: silver.cancelled_ride(bronze("cancelled_ride")),
        "incompleted_ride": lambda: silver.incompleted_ride(bronze("incompleted_ride")),
    }
    return counts | together(
        warehouse.spark, {f"silver.{t}": partial(write, t, build) for t, build in facts.items()})


def _stable_dimension(warehouse: Warehouse, name: str, bronze: DataFrame) -> DataFrame:
    """The names that Bronze has, with the ids of the stored key map; new names are added to it first."""
    key = silver.NAMED_DIMENSIONS[name][1]
    names = silver.names_of(name, bronze)
    warehouse.add_keys(new_ids(names, warehouse.key_map(name, key), key), name)
    return warehouse.key_map(name, key).join(names, "name", "left_semi").select(key, "name")


def gold_refresh(warehouse: Warehouse, *, run_ts: datetime | None = None, target_date: date | None = None,
                 by_month: bool = False, from_partials: bool = False) -> Counts:
    """Rebuild the three aggregates from Silver; by month from the bookings that carry their extraction month.

    ``from_partials`` adds up the stored partials of all months and reads no booking.
    """
    if from_partials and (by_month or target_date is not None):
        raise ValueError("partials have no result by month or for a single day")
    run_ts = run_ts or utc_now()
    bookings = warehouse.read("silver", "booking")
    if by_month:
        named = {name: warehouse.read("silver", name) for name in silver.NAMED_DIMENSIONS}
        bookings = silver.booking(warehouse.read("bronze", "booking"), named, carry_month=True)
    builds = {
        "daily_booking_summary": lambda: gold.daily_booking_summary(
            bookings, warehouse.read("silver", "vehicle_type"), warehouse.read("silver", "booking_status"),
            target_date=target_date, by_month=by_month),
        "customer_analytics": lambda: gold.customer_analytics(
            warehouse.read("silver", "customer"), bookings, by_month=by_month),
        "location_analytics": lambda: gold.location_analytics(
            bookings, warehouse.read("silver", "location"), by_month=by_month),
    }
    if from_partials:
        builds = {table: partial(partials.built, table, warehouse) for table in builds}

    def write(table: str) -> int:
        return warehouse.overwrite(audit(builds[table](), run_ts), "gold", table)

    return together(warehouse.spark, {f"gold.{table}": partial(write, table) for table in builds})


def _plain(path: str) -> str:
    """A path as one text, however its characters and its scheme are written."""
    return re.sub(r"^(\w+:)/+", r"\1/", unquote(path))


def _paths(rows: DataFrame) -> set[str]:
    """The files that rows come from."""
    return {_plain(r[0]) for r in rows.select(SOURCE_PATH).distinct().collect()}


def load_tidied(warehouse: Warehouse, tidied: DataFrame, extraction_date: date | None, *, label: str,
                no_date_filter: bool = False, mode: str = "replace", on_bad_date: str = "reject") -> Counts:
    """Stage the rows of a run once, load Bronze from the stage, store the run's rejects.

    The staged copy is columnar and holds the run's rows only, so nine extracts
    do not parse the file nine times.  With ``on_bad_date="fail"`` a bad date or
    record stops the run before anything is written.  Rejects are stored by the
    full path of their file below ``label``: loading a file again replaces that
    file's rejects only, with none if it has none now.
    """
    rows = tidied
    if extraction_date is not None and not no_date_filter:
        undated = F.col("date").isNull() & F.col(DATE_TEXT).isNotNull()
        rows = rows.where(in_month(F.col("date"), month_key(extraction_date)) | undated | F.col(BAD_RECORD).isNotNull())
    with settled(rows, "prepared") as staged:
        rejects = rejected(staged)
        if on_bad_date == "fail" and (bad := rejects.select("reason", DATE_TEXT, BAD_RECORD).first()) is not None:
            raise ValueError(f"too many fields: {bad[2]}" if bad[0] == "fields" else f"not a date: {bad[1]}")
        prepared = stamp(staged, extraction_date, no_date_filter=no_date_filter)
        month = None if extraction_date is None else month_key(extraction_date)
        counts = bronze_load(warehouse, prepared, month=month, mode=mode)
        stored = f"{warehouse.root}/rejects/{label}"
        rejects.withColumn("source_path", F.col(SOURCE_PATH)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("source_path").parquet(stored)
        # Files without a reject wrote no partition; those without a row of the run are known by the scan alone.
        loaded = {_plain(path) for path in tidied.inputFiles()} | _paths(staged)
        clean = loaded - _paths(rejects)
        for name in child_names(warehouse.spark, stored):
            if name.startswith("source_path=") and _plain(unquote(name.split("=", 1)[1])) in clean:
                delete_tree(warehouse.spark, f"{stored}/{name}")
        return counts


def load_file(warehouse: Warehouse, source_file: str | Sequence[str], extraction_date: date | None, *,
              no_date_filter: bool = False, mode: str = "replace", on_bad_date: str = "reject",
              spread_to: int | None = None) -> Counts:
    """Bronze from a booking file, a folder, a glob pattern or several of them; a missing one is an error.

    ``spread_to`` redistributes the rows over so many tasks, for few files that cannot be split.
    """
    spark = warehouse.spark
    paths = [source_file] if isinstance(source_file, str) else list(source_file)
    for path in paths:
        if not matches(spark, path):
            raise FileNotFoundError(f"source file not found: {path}")
    label = "all-months" if extraction_date is None else month_key(extraction_date)
    return load_tidied(warehouse, tidy(read_raw(spark, paths, spread_to=spread_to)), extraction_date, label=label,
                       no_date_filter=no_date_filter, mode=mode, on_bad_date=on_bad_date)


def run(spark: SparkSession, warehouse_root: str, source_file: str | Sequence[str] | None = None,
        extraction_date: date | None = None, *, run_bronze: bool = True, run_silver: bool = True,
        run_gold: bool = True, no_date_filter: bool = False, mode: str = "replace",
        on_bad_date: str = "reject", run_ts: datetime | None = None) -> dict[str, Counts]:
    """Bronze, Silver and Gold in order, each optional; rows written by layer and table."""
    warehouse = Warehouse(spark, warehouse_root)
    run_ts = run_ts or utc_now()
    results: dict[str, Counts] = {}
    if run_bronze:
        if source_file is None:
            raise ValueError("a source file is needed to load Bronze")
        results["bronze"] = load_file(warehouse, source_file, extraction_date or run_ts.date(),
                                      no_date_filter=no_date_filter, mode=mode, on_bad_date=on_bad_date)
    if run_silver:
        results["silver"] = silver_refresh(warehouse, run_ts=run_ts)
    if run_gold:
        results["gold"] = gold_refresh(warehouse, run_ts=run_ts)
    log.info("run finished: %s", results)
    return results


def run_month(spark: SparkSession, warehouse_root: str, source_file: str, year: int, month: int, day: int = 1,
              **options) -> dict[str, Counts]:
    """All layers for the month of one date."""
    if not 1 <= month <= 12:
        raise ValueError("month must be between 1 and 12")
    if not 1 <= day <= 31:
        raise ValueError("day must be between 1 and 31")
    return run(spark, warehouse_root, source_file, date(year, month, day), **options)


def run_all_months(spark: SparkSession, warehouse_root: str, source_file: str | Sequence[str], *,
                   mode: str = "replace", on_bad_date: str = "reject",
                   run_ts: datetime | None = None) -> dict[str, Counts]:
    """Every month of the files in one scan; each row belongs to the month of its own date."""
    warehouse = Warehouse(spark, warehouse_root)
    bronze_counts = load_file(warehouse, source_file, None, mode=mode, on_bad_date=on_bad_date)
    return {"bronze": bronze_counts, **backfill(spark, warehouse_root, run_ts=run_ts)}


def incremental(spark: SparkSession, warehouse_root: str, source_file: str, extraction_date: date | None = None, *,
                run_ts: datetime | None = None, stable_ids: bool = False, **options) -> dict[str, Counts]:
    """All layers for a new file, limited to the month of the extraction date.

    Customers and Gold are added up from partials by month, of which only the file's own month is renewed;
    ``stable_ids`` is as for ``silver_refresh``.
    """
    warehouse, run_ts = Warehouse(spark, warehouse_root), run_ts or utc_now()
    day = extraction_date or run_ts.date()
    results = run(spark, warehouse_root, source_file, day, run_silver=False, run_gold=False, run_ts=run_ts, **options)
    partials.refresh(warehouse, [month_key(day)])
    return results | {"silver": silver_refresh(warehouse, run_ts=run_ts, from_partials=True, stable_ids=stable_ids),
                      "gold": gold_refresh(warehouse, run_ts=run_ts, from_partials=True)}


def backfill(spark: SparkSession, warehouse_root: str, *, run_ts: datetime | None = None) -> dict[str, Counts]:
    """Silver and Gold again from the stored Bronze rows."""
    return run(spark, warehouse_root, run_bronze=False, run_ts=run_ts)
