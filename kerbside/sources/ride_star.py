"""Trip bookings out of a sales star schema: one booking per line item.

The sales tables stand in for the booking file: the expressions below give its
21 columns, with nulls, repeated booking ids and all five statuses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.functions.calendar import month_start, next_month_start
from kerbside.operators.spread import SLICE, deal, spread
from kerbside.schemas import SOURCE_COLUMNS
from kerbside.session import compile_in_pieces, spread_setting
from kerbside.sources.ride_csv import ORDER_PREFIX, REPEATED

# The mapping from the sales tables, valid in Spark SQL and ANSI SQL.
STATUS = (
    "case when l_returnflag = 'N' or (l_returnflag = 'A' and l_linestatus = 'F') then 'Completed' "
    "when l_returnflag = 'A' then 'Cancelled by Customer' "
    "when l_linestatus = 'F' then 'Cancelled by Driver' "
    "when l_linenumber % 2 = 0 then 'Incomplete' else 'No Driver Found' end"
)
MAPPING: dict[str, str] = {
    "date": "cast(l_shipdate as date)",
    "time": "concat(lpad(cast(l_partkey % 24 as string), 2, '0'), ':', "
            "lpad(cast(l_suppkey % 60 as string), 2, '0'), ':00')",
    "booking_id": "case when l_orderkey % 211 = 0 and l_linenumber = 7 then null else "
                  "concat('CNR', cast(l_orderkey as string), '-', cast(l_linenumber as string)) end",
    "booking_status": "status",
    "customer_id": "case when l_orderkey % 97 = 0 then null else concat('CID', cast(o_custkey as string)) end",
    "vehicle_type": "case when l_partkey % 101 = 0 then null else p_type end",
    "pickup_location": "customer_nation",
    "drop_location": "case when l_suppkey % 50 = 0 then null else supplier_nation end",
    "avg_vtat": "case when status <> 'No Driver Found' then cast(l_linenumber as double) * 2 end",
    "avg_ctat": "case when status in ('Completed', 'Incomplete') then l_quantity end",
    "cancelled_rides_by_customer": "case when status = 'Cancelled by Customer' then cast(1 as double) end",
    "customer_cancel_reason": "case when status = 'Cancelled by Customer' then case l_suppkey % 3 "
                              "when 0 then 'Wrong Address' when 1 then 'Change of plans' "
                              "else 'Driver not moving' end end",
    "cancelled_rides_by_driver": "case when status = 'Cancelled by Driver' then cast(1 as double) end",
    "driver_cancel_reason": "case when status = 'Cancelled by Driver' then case l_suppkey % 2 "
                            "when 0 then 'Customer issue' else 'Car issue' end end",
    "incomplete_rides": "case when status = 'Incomplete' then cast(1 as double) end",
    "incomplete_rides_reason": "case when status = 'Incomplete' then case l_suppkey % 2 "
                               "when 0 then 'Customer Demand' else 'Vehicle Breakdown' end end",
    "booking_value": "case when status in ('Completed', 'Incomplete') then l_extendedprice end",
    "ride_distance": "case when status in ('Completed', 'Incomplete') then l_quantity end",
    "driver_rating": "case when status = 'Completed' then 3 + l_discount * 20 end",
    "customer_rating": "case when status = 'Completed' then 3 + l_tax * 25 end",
    "payment_method": "case when status in ('Completed', 'Incomplete') then c_mktsegment end",
}
STATUSES = ["Completed", "Incomplete", "Cancelled by Customer", "Cancelled by Driver", "No Driver Found"]
# By how many of the statuses, in that order, a line's numbers are used in the mapping.
USED_BY = {"l_quantity": 2, "l_extendedprice": 2, "l_discount": 1, "l_tax": 1}
# With the date in front these give a total order of the rows.
ROW_ORDER = ["l_partkey", "l_suppkey", "l_orderkey", "l_linenumber"]
SOURCE_FILE = "lineitem.parquet"
LINE_MONTH = "line_month"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _marked(lines: DataFrame) -> DataFrame:
    """Dealt lines with a mark on those whose booking another one has in the month, as on all without an id."""
    alike = Window.partitionBy(LINE_MONTH, SLICE, _booking())
    return lines.withColumn(REPEATED, F.expr(MAPPING["booking_id"]).isNull() | (F.count(F.lit(1)).over(alike) > 1))


def _booking() -> Column:
    """The same for lines of one booking; lines without an id go by themselves, for they may be many."""
    return F.coalesce(F.expr(MAPPING["booking_id"]), F.xxhash64(*ROW_ORDER).cast("string"))


def joined_lines(spark: SparkSession, sf_dir: str, month: str | None = None, *, by_month: bool = False, mark: bool = False) -> DataFrame:
    """Line items with customer, supplier and part attributes.

    Customers are joined to the orders first, so lines meet one order side, and
    that first: they are the narrowest there, with a day and a status number for
    their time and flags and only the numbers that their status uses.  Nations go
    as keys until the end; the planner broadcasts the 25 from their file size.  A
    month is filtered on the stored timestamp, which the Parquet scan can skip by.
    ``by_month`` deals the lines by their month, while they are narrow still.  With
    ``mark`` those of one booking come together, which tells the bookings that repeat.
    """
    def table(name: str) -> DataFrame:
        return read_table(spark, sf_dir, name)

    lines = table("lineitem")
    if month:
        first, end = (F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in (month_start(month), next_month_start(month)))
        lines = lines.where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < end))
    number = F.array_position(F.array(*map(F.lit, STATUSES)), F.expr(STATUS))
    lines = lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *USED_BY, F.col("l_shipdate").cast("date").alias("l_shipdate"),
        number.cast("int").alias("status_number"))
    lines = spread(lines.withColumns(
        {c: F.when(F.col("status_number") <= n, F.col(c)) for c, n in USED_BY.items()}), spread_setting(spark))

    def nations(key: str, name: str) -> DataFrame:
        return table("nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))

    buyers = table("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    orders = table("orders").select("o_orderkey", "o_custkey").join(
        buyers, F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey")
    sellers = table("supplier").select("s_suppkey", "s_nationkey")
    parts = table("part").select("p_partkey", "p_type")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
        .join(parts, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey")
    )
    if mark:
        months = table("lineitem").groupBy(F.trunc("l_shipdate", "month")).agg(F.count(F.lit(1)))
        sizes = [n for _, n in months.collect()]  # a number per calendar month
        dealt = deal(joined.withColumn(LINE_MONTH, F.trunc("l_shipdate", "month")), LINE_MONTH, _booking(), sizes)
        joined = _marked(dealt).drop(LINE_MONTH, SLICE)
    elif by_month:
        joined = joined.withColumn(LINE_MONTH, F.trunc("l_shipdate", "month")).hint("rebalance", LINE_MONTH).drop(LINE_MONTH)
    return (
        joined.join(nations("c_nationkey", "customer_nation"), "c_nationkey")
        .join(nations("s_nationkey", "supplier_nation"), "s_nationkey")
        .withColumn("status", F.element_at(F.array(*map(F.lit, STATUSES)), F.col("status_number")))
    )


def ride_source(spark: SparkSession, sf_dir: str, month: str | None = None, *, by_month: bool = False, mark: bool = False) -> DataFrame:
    """The 21 typed source columns, file name and row order, and the mark if asked for."""
    return joined_lines(spark, sf_dir, month, by_month=by_month, mark=mark).select(
        *[F.expr(sql).alias(name) for name, sql in MAPPING.items()],
        F.lit(SOURCE_FILE).alias("source_file"),
        F.expr(MAPPING["date"]).alias(f"{ORDER_PREFIX}0"),
        *[F.col(c).alias(f"{ORDER_PREFIX}{i}") for i, c in enumerate(ROW_ORDER, 1)],
        *[REPEATED] * mark,
    )


def raw_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as untidy text under the file's own headers.

    Nulls become missing-value tokens in turn, ids are wrapped in quotes and
    text carries blanks, as in the booking file.
    """
    compile_in_pieces(spark)
    rides = ride_source(spark, sf_dir)
    token = F.element_at(F.array(*[F.lit(t) for t in ("null", "NaN", "NA", "N/A", "")]),
                         (F.col(f"{ORDER_PREFIX}4") % 5 + 1).cast("int"))
    texts = []
    for header, name, kind in SOURCE_COLUMNS:
        text = F.col(name).cast("string")
        if name in ("booking_id", "customer_id"):
            text = F.concat(F.lit('"'), text, F.lit('"'))
        elif kind == "string":
            text = F.concat(F.lit(" "), text, F.lit("\t "))
        texts.append(F.coalesce(text, token).alias(header))
    order = [c for c in rides.columns if c.startswith(ORDER_PREFIX)]
    return rides.select(*texts, "source_file", *order)


