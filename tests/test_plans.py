"""Plans that must hold at scale."""

import re

from conftest import SF_DIR, plan_of
from pyspark.sql import functions as F

from kerbside.plans import dashboard, gold, marts, silver
from kerbside.plans.bronze import EXTRACTS, extract
from kerbside.plans.registry import all_queries
from kerbside.plans.star_warehouse import star_warehouse
from kerbside.sources.ride_star import ride_source


def test_facts_are_never_numbered_in_one_task(spark):
    layers = star_warehouse(spark, SF_DIR)
    for name in ("cancelled_ride", "incompleted_ride"):
        plan = plan_of(getattr(silver, name)(layers.bronze(name)))
        assert "SinglePartition" not in plan and "rangepartitioning" in plan


def test_extracts_combine_before_the_shuffle(spark):
    prepared = star_warehouse(spark, SF_DIR).prepared()
    for name in EXTRACTS:
        plan = plan_of(extract(name, prepared))
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1, name
        assert "Partial" in plan and "Final" in plan, name


def test_extracts_read_their_own_columns(spark):
    prepared = star_warehouse(spark, SF_DIR).prepared()
    scan = re.search(r"ReadSchema: (\S+)", plan_of(extract("customer", prepared))).group(1)
    assert "booking_value" not in scan and "customer_id" in scan


def test_lookups_shuffle_no_fact_row(spark):
    layers = star_warehouse(spark, SF_DIR)
    plan = plan_of(silver.booking(layers.bronze("booking"), layers.dimensions()))
    assert plan.count("BroadcastHashJoin") == 5 and "SortMergeJoin" not in plan
    # The only shuffles are those of the dimensions' own names.
    assert all("hashpartitioning(name#" in line for line in plan.splitlines() if "Exchange hash" in line)


def test_large_dimensions_are_not_broadcast(spark):
    layers = star_warehouse(spark, SF_DIR)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        plan = plan_of(silver.booking(layers.bronze("booking"), layers.dimensions()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 5


def test_gold_aggregates_before_it_joins(spark):
    layers = star_warehouse(spark, SF_DIR)
    plan = plan_of(gold.daily_booking_summary(
        layers.silver("booking"), layers.silver("vehicle_type"), layers.silver("booking_status")))
    assert plan.index("BroadcastHashJoin") < plan.index("HashAggregate")
    assert "SortAggregate" not in plan
    places = plan_of(gold.location_analytics(layers.silver("booking"), layers.silver("location")))
    assert places.count("FileScan parquet") == 2  # both ends of the bookings in one scan, and the locations


def test_month_predicates_reach_the_scan(spark):
    layers = star_warehouse(spark, SF_DIR)
    plan = plan_of(dashboard.recalc_daily_summary(layers.bronze("booking"), "1997-03"))
    assert re.search(r"PartitionFilters: \[[^\]]*extraction_month", plan)
    source = plan_of(ride_source(spark, SF_DIR, "1997-03").select("booking_id"))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", source)
    projected = plan_of(all_queries()["store_read_projected"](spark, SF_DIR))
    assert "GreaterThan(booking_value" in projected and "drop_location" not in projected


def test_no_query_crosses_tables(spark):
    for name in ("mart_customer_sales", "mart_branch_sales", "report_revenue_share", "mart_referral_revenue",
                 "gold_location_analytics_by_month", "dash_filter_location_name"):
        plan = plan_of(all_queries()[name](spark, SF_DIR))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_marts_move_lines_once(spark):
    """With every join shuffled: lines cross one exchange, by their order; the mart's own rows are not lines."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("mart_customer_sales", "mart_customer_category", "mart_referral_revenue"):
            plan = plan_of(all_queries()[name](spark, SF_DIR))
            dealt = re.findall(r"Exchange hashpartitioning\(order_id#\d+L?[^)]*\), REPARTITION", plan)
            assert dealt and not re.search(r"hashpartitioning\(order_id#\d+L?, (year|month)", plan), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_months_come_from_folder_names(spark):
    layers = star_warehouse(spark, SF_DIR)
    layers.bronze("booking")
    assert "FileScan" not in plan_of(dashboard.available_months(layers.store))


def test_frequent_customers_meet_a_filter_once(spark):
    plan = plan_of(all_queries()["dash_filter_customer_id"](spark, SF_DIR))
    assert re.search(r"HashAggregate\(keys=\[customer_id", plan)


def test_marts_deal_lines_in_proportion_to_their_number(spark, monkeypatch):
    """Not over one task a core, whose memory would grow with the lines."""
    monkeypatch.setattr(marts, "LINES_A_TASK", 100)
    i = F.col("id")
    for n, tasks in ((250, 3), (1000, 10)):
        lines = spark.range(n).select(
            F.when(i % 9 != 0, i % 50).alias("order_id"), (i % 3).alias("seller_id"), i.cast("double").alias("value"),
            F.lit(2024).cast("bigint").alias("year"), (i % 2 + 1).alias("month"))
        buyer = spark.range(50).select(i.alias("order_id"), (i % 5).alias("customer_id"), F.lit("mail").alias("channel"))
        branch = spark.range(2).select(i.alias("seller_id"), F.lit("north").alias("branch"))
        for mart in (marts.customer_sales(lines, buyer), marts.customer_category(lines, buyer),
                     marts.referral_revenue(lines, buyer), marts.branch_sales(lines, branch)):
            dealt = re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, (\d+)\), REPARTITION", plan_of(mart))
            assert dealt and set(dealt) == {str(tasks)}
