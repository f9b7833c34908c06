"""Ad-hoc SQL: every stored table as a view, and the documented sample queries."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kerbside.schemas import view_name
from kerbside.sources.files import delete_tree, scratch_path
from kerbside.sources.warehouse import Warehouse

LISTING_VIEW = "table_listing"

# Sample queries in Spark SQL.  Every limit is applied under a total order, so
# the same rows come back on every run; money is added as decimals, so sums do
# not depend on row order either.
SAMPLES: dict[str, str] = {
    "list_gold": f"SELECT * FROM {LISTING_VIEW} WHERE view_name LIKE 'gold%'",
    "daily_summary": """
        SELECT date, vehicle_type_name, booking_status_name, total_bookings, total_revenue, avg_booking_value
        FROM gold_daily_booking_summary
        ORDER BY date, vehicle_type_name, booking_status_name LIMIT 100""",
    "top_customers": """
        SELECT customer_id, total_bookings, total_spent, avg_booking_value
        FROM gold_customer_analytics ORDER BY total_bookings DESC, customer_id LIMIT 10""",
    "revenue_by_vehicle": """
        SELECT vehicle_type_name, SUM(total_bookings) AS total_bookings,
               CAST(SUM(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue,
               ROUND(AVG(avg_booking_value), 6) AS avg_booking_value
        FROM gold_daily_booking_summary GROUP BY vehicle_type_name
        ORDER BY total_revenue DESC, vehicle_type_name""",
    "bookings_by_status": """
        SELECT booking_status_name, SUM(total_bookings) AS total_bookings,
               CAST(SUM(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE) AS total_revenue
        FROM gold_daily_booking_summary GROUP BY booking_status_name
        ORDER BY total_bookings DESC, booking_status_name""",
    "top_locations": """
        SELECT name, pickups, dropoffs, total_activity, avg_booking_value
        FROM gold_location_analytics ORDER BY total_activity DESC, name LIMIT 15""",
    "daily_trends": """
        SELECT date, SUM(total_bookings) AS daily_bookings,
               CAST(SUM(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE) AS daily_revenue
        FROM gold_daily_booking_summary GROUP BY date ORDER BY date DESC""",
    "customers": """
        SELECT customer_id, first_seen_date, last_seen_date, total_bookings
        FROM silver_customer ORDER BY customer_id LIMIT 100""",
    "raw_bookings": """
        SELECT * FROM bronze_booking ORDER BY booking_id, extraction_month LIMIT 50""",
    "revenue_by_vehicle_short": """
        SELECT vehicle_type_name, CAST(SUM(CAST(total_revenue AS DECIMAL(38,6))) AS DOUBLE) AS revenue,
               SUM(total_bookings) AS bookings
        FROM gold_daily_booking_summary GROUP BY vehicle_type_name
        ORDER BY revenue DESC, vehicle_type_name""",
    "top_spenders": """
        SELECT customer_id, total_bookings, total_spent
        FROM gold_customer_analytics ORDER BY total_spent DESC NULLS LAST, customer_id LIMIT 10""",
}


@dataclass(frozen=True)
class SqlResult:
    """What a query gave: its stored rows or the error text, and its metrics."""

    frame: DataFrame | None
    error: str | None
    rows: int | None
    columns: int | None
    seconds: float


def register_views(warehouse: Warehouse) -> list[str]:
    """One lazy view ``<layer>_<table>`` per stored table, and their listing; nothing is loaded."""
    stored = {(layer, table): warehouse.read(layer, table) for layer, table in warehouse.tables()}
    for (layer, table), df in stored.items():
        df.createOrReplaceTempView(view_name(layer, table))
    if stored:
        table_listing(stored).createOrReplaceTempView(LISTING_VIEW)
    return [view_name(*key) for key in stored]


def table_listing(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Layer, table, view, full name, rows and columns of every table.

    Counting rows needs the Parquet footers only.
    """
    def line(layer: str, table: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table"), F.lit(view_name(layer, table)).alias("view_name"),
            F.lit(f"{layer}.{table}").alias("full_name"), "rows",
            F.lit(len(df.columns)).cast("bigint").alias("columns"))

    return reduce(DataFrame.unionByName, [line(layer, table, df) for (layer, table), df in tables.items()])


def describe_view(spark: SparkSession, view: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {view}")


def sample(spark: SparkSession, name: str) -> DataFrame:
    """Run a sample query over the registered views."""
    return spark.sql(SAMPLES[name])


# What may be run besides queries: statements that only tell about tables.
TELLING = ("Describe", "Show", "Explain")


def changing_command(spark: SparkSession, text: str) -> str | None:
    """The kind of statement in ``text`` that changes something, by its parsed plan; None for queries."""
    kinds = [spark._jvm.java.lang.Class.forName(f"org.apache.spark.sql.catalyst.plans.logical.{k}") for k in ("Command", "ParsedStatement")]

    def first(plan) -> str | None:
        name = plan.getClass().getSimpleName()
        if any(k.isInstance(plan) for k in kinds) and not name.startswith(TELLING):
            return name
        children = plan.children()
        return next((found for i in range(children.size()) if (found := first(children.apply(i)))), None)

    return first(spark._jsparkSession.sessionState().sqlParser().parsePlan(text))


def run_sql(spark: SparkSession, text: str, args: dict | list | None = None) -> SqlResult:
    """Run a Spark SQL query over the views once, all its columns; errors come back as text.

    ``args`` fills parameters (``:name`` or ``?``) by value, never by text.  Statements that would change a table, a
    view or a setting are not run.

    The rows are written to the shared folder while they are counted, in the
    result's order, and ``frame`` reads them from there.
    """
    started = time.monotonic()
    path = scratch_path(spark, "sql")
    try:
        if (command := changing_command(spark, text)) is not None:
            return SqlResult(None, f"only queries are run here, not {command}", None, None, time.monotonic() - started)
        frame = spark.sql(text, args=args)
        seen = Observation()
        # Names may repeat or be empty in a result, but not in a file.
        plain = frame.toDF(*[f"c{i}" for i in range(len(frame.columns))]).observe(seen, F.count(F.lit(1)).alias("rows"))
        if plain.columns:
            plain.withColumns({c: F.col(c).cast("string") for c, kind in plain.dtypes if kind == "void"}).write.parquet(path)
        rows = seen.get["rows"] if plain.columns else 0
    except (PySparkException, Py4JJavaError) as error:
        delete_tree(spark, path)
        return SqlResult(None, str(error), None, None, time.monotonic() - started)
    if not plain.columns:
        return SqlResult(frame, None, rows, 0, time.monotonic() - started)
    stored = spark.read.parquet(path).toDF(*frame.columns)
    return SqlResult(stored, None, rows, len(frame.columns), time.monotonic() - started)


def export_csv(df: DataFrame, folder: str) -> None:
    """Write a result as CSV with a header, one file per task."""
    df.write.mode("overwrite").option("header", True).csv(folder)
