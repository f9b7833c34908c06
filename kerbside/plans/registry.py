"""Every registered query by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.calendar import month_start
from kerbside.functions.text import clean_text, na_to_null, to_date, to_number
from kerbside.operators.dense_id import dense_id
from kerbside.operators.in_place import keep_first_in_place
from kerbside.operators.keep_first import keep_first
from kerbside.operators.profile import QUARTILES, column_profile, describe, table_size
from kerbside.operators.settle import settle
from kerbside.operators.stable_id import new_ids
from kerbside.operators.upsert import upsert
from kerbside.plans import bronze, dashboard, gold, marts, partials, reports, silver, sql_views, verification
from kerbside.plans.star_warehouse import StarWarehouse, star_warehouse
from kerbside.schemas import AUDIT_COLUMNS, SOURCE_COLUMNS, TABLES
from kerbside.sources.files import delete_tree, scratch_path
from kerbside.sources.ride_csv import BAD_RECORD, order_columns, read_raw, stamp, tidy
from kerbside.sources.ride_star import raw_rides, read_table, ride_source
from kerbside.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]

# The month that single-month queries look at.
MONTH = "1997-03"
# The state shown by the as-of query, and where the upsert splits old from new.
AS_OF = "1998-06"
# Spans of months compared by customer retention.
SPANS = [("1995-01", "1995-12", "1996-01", "1996-12"), ("1997-01", "1997-01", "1997-02", "1997-02"), ("1990-01", "1990-12", "1992-01", "1992-03")]
# Up to where the first customers get their ids.
FIRST_SEEN = "1992-06"


def _without_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)


def on_layers(build: Callable[[StarWarehouse], DataFrame]) -> Query:
    """A query over the stored layers."""
    return lambda spark, sf_dir: _without_audit(build(star_warehouse(spark, sf_dir)))


# ---- sources and store ----

def src_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untidy text of every booking through clean-up, typing and month stamp."""
    stamped = stamp(tidy(raw_rides(spark, sf_dir)), None)
    return stamped.drop(*order_columns(stamped))


def src_csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as a CSV whose texts go over lines, some records too short or too long, and read again."""
    path = scratch_path(spark, "records")
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
              for c in (F.col("text"), F.col("lang"), F.col("source"))]
    fields = [F.col("doc_id").cast("string"), *quoted]
    kind = F.col("doc_id") % 7
    record = F.when(kind == 3, F.concat_ws(",", *fields[:2])).when(kind == 5, F.concat_ws(",", *fields, F.lit("one"), F.lit("too, many")))
    lines = read_table(spark, sf_dir, "documents").select(
        F.coalesce(record, F.concat_ws(",", *fields)).alias("record"), F.monotonically_increasing_id().alias("row"))
    is_first = F.col("row").bitwiseAND((1 << 33) - 1) == 0  # of its file
    lines.select(F.when(is_first, F.concat(F.lit(" doc_id,text ,lang,source\n"), "record")).otherwise(F.col("record"))).write.text(path)
    try:
        return settle(read_raw(spark, path).select(
            F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"), "lang", "source",
            F.col(BAD_RECORD).isNotNull().alias("too_long")), "records")
    finally:
        delete_tree(spark, path)


def src_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(
        "doc_id", *[clean_text(F.col(c)).alias(c) for c in ("text", "lang", "source")])


def src_na_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens to null and numbers typed; text columns keep their quotes and blanks."""
    raw = raw_rides(spark, sf_dir)
    kinds = {"string": lambda c: c, "double": to_number, "date": to_date}
    columns = [kinds[kind](na_to_null(F.col(header))).alias(name)
               for header, name, kind in SOURCE_COLUMNS]
    return raw.select(*columns)


def src_month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stamp(ride_source(spark, sf_dir, MONTH), month_start(MONTH))
    return rows.select("booking_id", "date", "time", "booking_status", "booking_value",
                       "extraction_date", "extraction_month", "source_file")


def store_read_projected(layers: StarWarehouse) -> DataFrame:
    layers.bronze("booking")
    return layers.store.read("bronze", "booking", ["booking_id", "customer_id", "booking_value"],
                             (F.col("extraction_month") == MONTH) & (F.col("booking_value") > 1000))


def store_upsert(layers: StarWarehouse) -> DataFrame:
    """Bookings loaded up to a month, overwritten by those loaded later: newest row per booking."""
    rows = layers.bronze("booking").select("booking_id", "extraction_month", "booking_status", "booking_value", "date")
    newest = [F.desc("extraction_month")]
    older = keep_first(rows.where(F.col("extraction_month") <= AS_OF), ["booking_id"], newest)
    return upsert(older, rows.where(F.col("extraction_month") > AS_OF), ["booking_id"], newest)


def store_upsert_months(layers: StarWarehouse) -> DataFrame:
    """Later bookings upserted into a stored table of the earlier ones: only the months they touch are rewritten."""
    rows = layers.bronze("booking")
    store = Warehouse(layers.spark, f"{layers.store.root}/_upserts/{uuid4().hex}")
    newest = [F.desc("extraction_month")]
    store.create("bronze", "booking")
    older = keep_first_in_place(rows.where(F.col("extraction_month") <= AS_OF), ["booking_id"], newest)
    store.append(older, "bronze", "booking", dealt=True)
    store.upsert(rows.where(F.col("extraction_month") > AS_OF), "bronze", "booking", ["booking_id"], newest, dealt=True)
    return store.read("bronze", "booking", ["booking_id", "extraction_month", "booking_status", "booking_value", "date"])


def key_stable_customers(layers: StarWarehouse) -> DataFrame:
    """Ids of customers: those seen up to a month were numbered first and keep their ids when the others come."""
    people = layers.bronze("booking").select(F.col("customer_id").alias("name"), "extraction_month")
    nobody = layers.spark.createDataFrame([], "customer_key bigint, name string")
    first = settle(new_ids(people.where(F.col("extraction_month") <= FIRST_SEEN), nobody, "customer_key"), "keys")
    return first.unionByName(new_ids(people, first, "customer_key"))


def report_retention_span(layers: StarWarehouse) -> DataFrame:
    """Customers of a span of months that book again in a later one, from month bitmaps of dense customer ids."""
    people = layers.silver("customer").select(F.col("customer_id").alias("name"))
    ids = settle(dense_id(people, "id", ["name"]).withColumnRenamed("name", "customer_id"), "customer-ids")
    return reports.retention_between(settle(reports.customer_bitmaps(layers.bronze("booking"), ids), "month-bitmaps"), SPANS)


def store_as_of_month(layers: StarWarehouse) -> DataFrame:
    """Customer analytics as they stood when a month had been loaded."""
    layers.bronze("booking")
    bookings = layers.store.as_of_month("booking", AS_OF)
    return gold.customer_analytics(silver.customer(bookings), bookings)


def table_listing(layers: StarWarehouse) -> DataFrame:
    tables = {key: df for layer in TABLES for key, df in layers.layer(layer).items()}
    return sql_views.table_listing(tables)


# ---- Bronze, Silver, Gold ----

def bronze_table(name: str) -> Query:
    return on_layers(lambda layers: layers.extract(name))


def silver_dimension(name: str) -> Query:
    return on_layers(lambda layers: silver.dimension(name, layers.bronze(name)))


def silver_fact(name: str) -> Query:
    build = getattr(silver, name)
    return on_layers(lambda layers: build(layers.bronze(name)))


def _month_bookings(layers: StarWarehouse) -> DataFrame:
    """Silver bookings that carry their extraction month: lookups only, no shuffle."""
    return silver.booking(layers.bronze("booking"), layers.dimensions(), carry_month=True)


def gold_daily(layers: StarWarehouse, by_month: bool) -> DataFrame:
    bookings = _month_bookings(layers) if by_month else layers.silver("booking")
    return gold.daily_booking_summary(bookings, layers.silver("vehicle_type"), layers.silver("booking_status"),
                                      by_month=by_month)


def gold_customers(layers: StarWarehouse, by_month: bool) -> DataFrame:
    bookings = layers.bronze("booking") if by_month else layers.silver("booking")
    return gold.customer_analytics(layers.silver("customer"), bookings, by_month=by_month)


def gold_locations(layers: StarWarehouse, by_month: bool) -> DataFrame:
    bookings = _month_bookings(layers) if by_month else layers.silver("booking")
    return gold.location_analytics(bookings, layers.silver("location"), by_month=by_month)


# ---- read side ----

def _from_partials(name: str, layers: StarWarehouse) -> DataFrame:
    """A table added up from the partials of all months, one of which was emptied and brought back."""
    for table in ("customer", "vehicle_type", "booking_status", "location"):
        layers.silver(table)
    layers.partials(MONTH)
    return partials.built(name, layers.store)


def _stored_months(layers: StarWarehouse) -> DataFrame:
    layers.bronze("booking")
    return dashboard.available_months(layers.store)


def _daily(layers: StarWarehouse) -> DataFrame:
    return layers.gold("daily_booking_summary").drop("extraction_month")


def _customers(layers: StarWarehouse) -> DataFrame:
    return layers.gold("customer_analytics").drop("extraction_month")


def _locations(layers: StarWarehouse) -> DataFrame:
    return layers.gold("location_analytics").drop("extraction_month")


def _rounded(df: DataFrame) -> DataFrame:
    """Means, deviations and interpolated quartiles differ between engines in the last bits."""
    return df.withColumns({c: F.round(c, 6) for c in ("mean", "std", *QUARTILES)})


def sample_sql(name: str, tables: list[tuple[str, str]]) -> Query:
    def run(layers: StarWarehouse) -> DataFrame:
        for layer, table in tables:
            layers.table(layer, table).createOrReplaceTempView(f"{layer}_{table}")
        if name == "list_gold":
            sql_views.table_listing(layers.layer("gold")).createOrReplaceTempView(sql_views.LISTING_VIEW)
        return sql_views.sample(layers.spark, name)

    return on_layers(run)


DAILY = ("gold", "daily_booking_summary")
CUSTOMERS = ("gold", "customer_analytics")
LOCATIONS = ("gold", "location_analytics")

SQL_TABLES = {
    "list_gold": [], "daily_summary": [DAILY], "top_customers": [CUSTOMERS], "revenue_by_vehicle": [DAILY],
    "bookings_by_status": [DAILY], "top_locations": [LOCATIONS], "daily_trends": [DAILY],
    "customers": [("silver", "customer")], "raw_bookings": [("bronze", "booking")],
    "revenue_by_vehicle_short": [DAILY], "top_spenders": [CUSTOMERS],
}


def mart(build: Callable[..., DataFrame], *sides: Callable) -> Query:
    return lambda spark, sf_dir: build(*[side(spark, sf_dir) for side in (marts.sales, *sides)])


def _retention(sale_lines: DataFrame, buyer: DataFrame) -> DataFrame:
    return marts.retention(marts.customer_category(sale_lines, buyer))


def all_queries() -> dict[str, Query]:
    queries: dict[str, Query] = {
        "src_prepare": src_prepare,
        "src_clean_text": src_clean_text,
        "src_csv_records": src_csv_records,
        "src_csv_records": src_csv_records,
        "src_na_normalise": src_na_normalise,
        "src_month_slice": src_month_slice,
        "store_read_projected": on_layers(store_read_projected),
        "store_upsert": on_layers(store_upsert),
        "store_upsert_months": on_layers(store_upsert_months),
        "key_stable_customers": on_layers(key_stable_customers),
        "store_as_of_month": on_layers(store_as_of_month),
    }
    queries |= {f"bronze_{name}": bronze_table(name) for name in bronze.EXTRACTS}
    queries["silver_customer"] = on_layers(lambda w: silver.customer(w.bronze("booking")))
    queries |= {f"silver_{name}": silver_dimension(name) for name in silver.NAMED_DIMENSIONS}
    queries["silver_booking"] = on_layers(lambda w: silver.booking(w.bronze("booking"), w.dimensions()))
    queries |= {f"silver_{name}": silver_fact(name) for name in ("ride", "cancelled_ride", "incompleted_ride")}
    queries["silver_ride_times"] = on_layers(lambda w: silver.ride_times(w.prepared()))
    queries["silver_cancellation_actor"] = on_layers(lambda w: silver.cancellation_actor(w.prepared()))
    for name, build in (("daily_booking_summary", gold_daily), ("customer_analytics", gold_customers),
                        ("location_analytics", gold_locations)):
        queries[f"gold_{name}"] = on_layers(partial(build, by_month=False))
        queries[f"gold_{name}_by_month"] = on_layers(partial(build, by_month=True))
    queries |= {f"inc_{name}": on_layers(partial(_from_partials, name)) for name in (
        "customer", "daily_booking_summary", "customer_analytics", "location_analytics")}
    queries |= {
        "dash_months": on_layers(_stored_months),
        "dash_filter_direct": on_layers(lambda w: dashboard.filter_direct(w.bronze("ride"), MONTH)),
        "dash_filter_booking_id": on_layers(lambda w: dashboard.filter_month(
            w.silver("ride"), "silver", "ride", MONTH, w.bronze("booking")).drop("ride_id")),
        "dash_filter_customer_id": on_layers(lambda w: dashboard.filter_month(
            _customers(w), *CUSTOMERS, MONTH, w.bronze("booking"))),
        "dash_filter_location_name": on_layers(lambda w: dashboard.filter_month(
            _locations(w).drop("location_id"), *LOCATIONS, MONTH, w.bronze("booking"))),
        "dash_recalc_daily_summary": on_layers(lambda w: dashboard.recalc_daily_summary(w.bronze("booking"), MONTH)),
        "dash_kpis": on_layers(lambda w: dashboard.kpis(_daily(w))),
        "dash_daily_trend": on_layers(lambda w: dashboard.daily_trend(_daily(w))),
        "dash_daily_revenue": on_layers(lambda w: dashboard.daily_revenue(_daily(w))),
        "dash_status_breakdown": on_layers(lambda w: dashboard.status_breakdown(_daily(w))),
        "dash_vehicle_breakdown": on_layers(lambda w: dashboard.vehicle_breakdown(_daily(w))),
        "dash_top_customers": on_layers(lambda w: dashboard.top_customers(_customers(w))),
        "dash_top_locations": on_layers(lambda w: dashboard.top_locations(_locations(w))),
        "profile_table_size": on_layers(lambda w: table_size(w.silver("booking"))),
        "profile_describe": on_layers(lambda w: _rounded(describe(_without_audit(w.silver("booking"))))),
        "profile_columns": on_layers(lambda w: column_profile(w.bronze("booking"))),
        "cat_table_listing": on_layers(table_listing),
    }
    queries |= {f"sql_{name}": sample_sql(name, tables) for name, tables in SQL_TABLES.items()}
    queries |= {
        "verify_partition_count": on_layers(lambda w: verification.partition_count(w.bronze("booking"), MONTH)),
        "verify_date_range": on_layers(lambda w: verification.date_range(w.bronze("booking"), MONTH)),
        "verify_cardinalities": on_layers(lambda w: verification.cardinalities(
            w.silver("customer"), w.silver("vehicle_type"), w.silver("location"))),
        "verify_vehicle_ids": on_layers(lambda w: verification.vehicle_ids(w.silver("vehicle_type"))),
        "verify_month_totals": on_layers(lambda w: verification.month_totals(_daily(w), MONTH)),
        "verify_top_vehicle_revenue": on_layers(lambda w: verification.top_vehicle_revenue(_daily(w), MONTH)),
        "verify_top_spenders": on_layers(lambda w: verification.top_spenders(_customers(w))),
        "verify_top_locations": on_layers(lambda w: verification.top_locations(_locations(w))),
        "verify_partition_summary": on_layers(lambda w: verification.partition_summary(w.bronze("booking"), MONTH)),
        "report_mom_growth": on_layers(lambda w: reports.mom_growth(w.bronze("booking"))),
        "report_first_booking_cohort": on_layers(lambda w: reports.first_booking_cohort(_customers(w))),
        "report_daily_revenue": on_layers(lambda w: reports.daily_revenue(_daily(w), MONTH)),
        "report_retention_span": on_layers(report_retention_span),
        "report_peak_hours": on_layers(lambda w: reports.peak_hours(w.silver("booking"))),
        "report_revenue_share": on_layers(lambda w: reports.revenue_share(_daily(w))),
        "report_bookings_per_month": on_layers(lambda w: reports.bookings_per_month(w.silver("booking"))),
        "mart_product_changes": mart(marts.product_changes, marts.products),
        "mart_referral_revenue": mart(marts.referral_revenue, marts.buyers),
        "mart_monthly_growth": mart(marts.monthly_growth),
        "mart_customer_sales": mart(marts.customer_sales, marts.buyers),
        "mart_retention": mart(_retention, marts.buyers),
        "mart_customer_category": mart(marts.customer_category, marts.buyers),
        "mart_branch_sales": mart(marts.branch_sales, marts.branches),
    }
    return queries
