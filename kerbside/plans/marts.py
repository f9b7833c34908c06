"""Seven sales marts of the Gold data dictionary.

The dictionary's rules divide counts by the company's income; its descriptions
ask for a share of sales.  Here counts are divided by the company's count and
values by its income, both of the same month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.money import money_sum, percent
from kerbside.plans.reports import previous_month_value
from kerbside.sources.ride_star import read_table

PERIOD = ["year", "month"]
LINES_A_TASK = 500_000


def sales(spark, sf_dir: str) -> DataFrame:
    """Sale lines: order, product, seller, value, month and change flag."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"), F.col("l_extendedprice").alias("value"),
        F.year("l_shipdate").cast("bigint").alias("year"), F.month("l_shipdate").cast("bigint").alias("month"),
        (F.col("l_returnflag") == "R").alias("is_change"))


def buyers(spark, sf_dir: str) -> DataFrame:
    """Order -> customer and the channel that referred the customer."""
    customers = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("channel"))
    return read_table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), "channel")


def products(spark, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))


def branches(spark, sf_dir: str) -> DataFrame:
    nations = read_table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("branch"))
    return read_table(spark, sf_dir, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("seller_id"), "branch")


def product_changes(sale_lines: DataFrame, product: DataFrame) -> DataFrame:
    """Changes per product and month; names join the counts, not the lines."""
    counts = sale_lines.where("is_change").groupBy("product_id", *PERIOD).agg(F.count(F.lit(1)).alias("changes"))
    return counts.join(product, "product_id").select("product_id", "product_name", "changes", *PERIOD)


def _tasks(sale_lines: DataFrame) -> int:
    """Over how many tasks lines are dealt: in proportion to their number, which a scan has from the file footers.

    Left to adaptive execution, narrow lines are coalesced to one task a core, whose hash tables and sorts then grow
    with the input.
    """
    return max(2, -(-sale_lines.count() // LINES_A_TASK))


def _by_order(sale_lines: DataFrame, tasks: int) -> DataFrame:
    """Lines dealt by their order: grouping per order, with whatever else, and the join with the orders' buyers all
    find them in place, so lines are shuffled once.  An order's lines are few."""
    return sale_lines.where(F.col("order_id").isNotNull()).repartition(tasks, "order_id")


def _per_order(sale_lines: DataFrame) -> DataFrame:
    """Lines combined per order and month."""
    return _by_order(sale_lines, _tasks(sale_lines)).groupBy("order_id", *PERIOD).agg(money_sum(F.col("value")).alias("value"))


def referral_revenue(sale_lines: DataFrame, buyer: DataFrame) -> DataFrame:
    """Revenue per referral channel and month, and its share of the month's revenue."""
    by_channel = (
        _per_order(sale_lines).join(buyer, "order_id").groupBy("channel", *PERIOD)
        .agg(money_sum(F.col("value")).alias("revenue"))
    )
    # Proven bound of the broadcast: one row per calendar month.
    month = by_channel.groupBy(*PERIOD).agg(money_sum(F.col("revenue")).alias("all_revenue"))
    return by_channel.join(F.broadcast(month), PERIOD).select(
        "channel", *PERIOD, "revenue", percent(F.col("revenue"), F.col("all_revenue")).alias("revenue_percent"))


def monthly_growth(sale_lines: DataFrame) -> DataFrame:
    """Revenue per month and growth in percent over the calendar month before."""
    per_month = sale_lines.groupBy(*PERIOD).agg(money_sum(F.col("value")).alias("revenue")).withColumn(
        "first_day", F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)))
    return per_month.withColumn("previous", previous_month_value("revenue", "first_day")).select(
        *PERIOD, "revenue", (percent(F.col("revenue"), F.col("previous")) - 100).alias("growth_percent"))


def _with_shares(mart: DataFrame, per_order: DataFrame) -> DataFrame:
    """Shares of the company's orders and revenue of the month.

    The totals come from the same per-order rows as the mart, so that shuffle is
    shared.  Proven bound of the broadcast: one row per calendar month, 12 a year.
    """
    company = per_order.groupBy(*PERIOD).agg(
        F.count(F.lit(1)).alias("all_orders"), money_sum(F.col("value")).alias("all_revenue"))
    return mart.join(F.broadcast(company), PERIOD).withColumns({
        "orders_percent": percent(F.col("orders"), F.col("all_orders").cast("double")),
        "revenue_percent": percent(F.col("revenue"), F.col("all_revenue")),
    }).drop("all_orders", "all_revenue")


def customer_sales(sale_lines: DataFrame, buyer: DataFrame) -> DataFrame:
    """Distinct orders and value per customer and month, with shares.

    Lines are combined per order first, so an order counts once by
    construction and the join with the buyers carries orders, not lines.
    """
    per_order = _per_order(sale_lines)
    mart = (
        per_order.join(buyer, "order_id").groupBy("customer_id", *PERIOD)
        .agg(F.count(F.lit(1)).alias("orders"), money_sum(F.col("value")).alias("revenue"))
    )
    return _with_shares(mart, per_order).select(
        "customer_id", "orders", "revenue", "orders_percent", "revenue_percent", *PERIOD)


def customer_category(sale_lines: DataFrame, buyer: DataFrame) -> DataFrame:
    """'ocasional' with one distinct order in the month, 'frecuente' with more."""
    per_customer = (
        _by_order(sale_lines.select("order_id", *PERIOD), _tasks(sale_lines)).distinct().join(buyer, "order_id")
        .groupBy("customer_id", *PERIOD).agg(F.count(F.lit(1)).alias("orders"))
    )
    kind = F.when(F.col("orders") == 1, "ocasional").otherwise("frecuente")
    return per_customer.select("customer_id", kind.alias("category"), *PERIOD)


def retention(categories: DataFrame) -> DataFrame:
    """Customers, frequent and occasional ones, and the share of frequent ones per month."""
    counted = categories.groupBy(*PERIOD).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count(F.when(F.col("category") == "frecuente", F.lit(1))).alias("frequent"),
        F.count(F.when(F.col("category") == "ocasional", F.lit(1))).alias("occasional"))
    return counted.select("customers", "frequent", "occasional",
                          percent(F.col("frequent"), F.col("customers").cast("double")).alias("frequent_percent"),
                          *PERIOD)


def branch_sales(sale_lines: DataFrame, branch: DataFrame) -> DataFrame:
    """Distinct orders and revenue per branch and month, with shares.

    An order may be served by several branches; it counts once in each, and
    once in the company's total.  Lines meet the branches before they are dealt
    by order, and both groupings work on what was dealt.
    """
    served = _by_order(sale_lines.join(branch, "seller_id", "left"), _tasks(sale_lines))
    mart = (
        served.where(F.col("branch").isNotNull())
        .groupBy("order_id", *PERIOD, "branch").agg(money_sum(F.col("value")).alias("value"))
        .groupBy("branch", *PERIOD)
        .agg(F.count(F.lit(1)).alias("orders"), money_sum(F.col("value")).alias("revenue"))
    )
    per_order = served.groupBy("order_id", *PERIOD).agg(money_sum(F.col("value")).alias("value"))
    return _with_shares(mart, per_order).select(
        "branch", "orders", "revenue", "orders_percent", "revenue_percent", *PERIOD)
