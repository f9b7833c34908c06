"""The same queries in plain SQL over the sales tables, for an independent engine.

Each statement is self-contained: it lists the building blocks it needs as
common table expressions.  Money is added as decimals of six digits after the point.
"""

from __future__ import annotations

import re

from kerbside.functions.text import BLANKS
from kerbside.plans.registry import AS_OF, FIRST_SEEN, MONTH, SPANS
from kerbside.schemas import SOURCE_COLUMNS, TABLES
from kerbside.sources.ride_star import MAPPING, ROW_ORDER, SOURCE_FILE, STATUS


def total(value: str) -> str:
    return f"cast(coalesce(sum(cast({value} as decimal(38,6))), 0) as double)"


def mean(value: str) -> str:
    return f"cast(sum(cast({value} as decimal(38,6))) as double) / nullif(count({value}), 0)"


def ratio(top: str, bottom: str) -> str:
    return f"case when {bottom} > 0 then {top} / {bottom} else 0.0::double end"


def month_range(column: str) -> str:
    return f"{column} >= date '{MONTH}-01' and {column} < cast(date '{MONTH}-01' + interval 1 month as date)"


ORDER = ", ".join(f"o{i} nulls first" for i in range(len(ROW_ORDER) + 1))
LINEAGE = "extraction_date, extraction_month, source_file"
RIDE_COLUMNS = ", ".join(name for _, name, _ in SOURCE_COLUMNS)


def first_per(columns: str, keys: str, source: str, where: str, names: str | None = None) -> str:
    """First row per key and month; ``names`` are the column names if ``columns`` are expressions."""
    names = names or columns
    values = ", ".join(f"{name.strip()} nulls first" for name in names.split(","))
    month = "" if "extraction_month" in names else ", extraction_month"
    return (
        f"select {names} from (select *, row_number() over (partition by {keys}, extraction_month "
        f"order by {ORDER}, {values}) as rn from (select {columns}{month}, o0, o1, o2, o3, o4 from {source} "
        f"where {where})) where rn = 1"
    )


def named(column: str, source: str) -> str:
    return first_per(f"{source} as {column}, booking_id, {LINEAGE}", f"{column}, booking_id", "ride",
                     f"{source} is not null", f"{column}, booking_id, {LINEAGE}")


BOOKING = ("booking_id, customer_id, vehicle_type, pickup_location, drop_location, booking_status, payment_method, "
           "booking_value, date, time")
COMPLETED = "booking_status = 'Completed' and booking_id is not null"
CANCELLED = "cancelled_rides_by_customer is not null or cancelled_rides_by_driver is not null"


def dimension(id_column: str, names: str) -> str:
    return (f"select row_number() over (order by name) as {id_column}, name from "
            f"(select distinct name from ({names}) where name is not null)")


def daily(source: str, month: str = "") -> str:
    return (
        f"select b.date, v.name as vehicle_type_name, s.name as booking_status_name, "
        f"count(b.booking_id) as total_bookings, {total('b.booking_value')} as total_revenue, "
        f"{mean('b.booking_value')} as avg_booking_value{month and ', b.extraction_month'} from {source} b "
        f"join silver_vehicle_type v using (vehicle_type_id) join silver_booking_status s using (booking_status_id) "
        f"group by b.date, v.name, s.name{month and ', b.extraction_month'}"
    )


def customers(bookings: str, people: str = "silver_customer", month: str = "") -> str:
    extra = month and ", extraction_month"
    return (
        f"select c.customer_id, c.first_seen_date, c.last_seen_date, t.total_bookings, t.total_spent, "
        f"t.avg_booking_value, t.first_booking_date, t.last_booking_date, "
        f"cast(t.last_booking_date - t.first_booking_date as bigint) as customer_lifetime_days{extra} "
        f"from {people} c left join (select customer_id, count(booking_id) as total_bookings, "
        f"{total('booking_value')} as total_spent, {mean('booking_value')} as avg_booking_value, "
        f"min(date) as first_booking_date, max(date) as last_booking_date{extra} from {bookings} "
        f"where customer_id is not null group by customer_id{extra}) t using (customer_id)"
    )


def locations(bookings: str, month: str = "") -> str:
    extra = month and ", extraction_month"
    on_month = month and " and d.extraction_month = p.extraction_month"
    return (
        f"select l.location_id, l.name, coalesce(p.pickups, 0) as pickups, coalesce(d.dropoffs, 0) as dropoffs, "
        f"coalesce(p.avg_booking_value, 0.0::double) as avg_booking_value, "
        f"coalesce(p.pickups, 0) + coalesce(d.dropoffs, 0) as total_activity{month and ', p.extraction_month'} "
        f"from silver_location l left join (select pickup_location_id as location_id, count(booking_id) as pickups, "
        f"{mean('booking_value')} as avg_booking_value{extra} from {bookings} group by pickup_location_id{extra}) p "
        f"on p.location_id = l.location_id left join (select drop_location_id as location_id, "
        f"count(booking_id) as dropoffs{extra} from {bookings} group by drop_location_id{extra}) d "
        f"on d.location_id = l.location_id{on_month}"
    )


SEEN = ("select customer_id, min(date) as first_seen_date, max(date) as last_seen_date, "
        "count(booking_id) as total_bookings from {} where customer_id is not null group by customer_id")

# Building blocks, each using only those above it.
BLOCKS: dict[str, str] = {
    "lines": f"select l.*, o.o_custkey, c.c_mktsegment, cn.n_name as customer_nation, sn.n_name as supplier_nation, "
             f"p.p_type, {STATUS} as status from lineitem l join orders o on l.l_orderkey = o.o_orderkey "
             f"join customer c on o.o_custkey = c.c_custkey join nation cn on c.c_nationkey = cn.n_nationkey "
             f"join supplier s on l.l_suppkey = s.s_suppkey join nation sn on s.s_nationkey = sn.n_nationkey "
             f"join part p on l.l_partkey = p.p_partkey",
    "ride": "select " + ", ".join(f"{sql} as {name}" for name, sql in MAPPING.items())
            + ", cast(date_trunc('month', l_shipdate) as date) as extraction_date, "
            + f"strftime(l_shipdate, '%Y-%m') as extraction_month, '{SOURCE_FILE}' as source_file, "
            + "cast(l_shipdate as date) as o0, " + ", ".join(f"{c} as o{i}" for i, c in enumerate(ROW_ORDER, 1))
            + " from lines",
    "bronze_customer": first_per(f"customer_id, booking_id, {LINEAGE}", "customer_id, booking_id", "ride",
                                 "customer_id is not null", f"customer_id, booking_id, {LINEAGE}"),
    "bronze_vehicle_type": named("vehicle_type_name", "vehicle_type"),
    "both_ends": "select pickup_location as location_name, 'pickup' as location_type, * from ride union all by name "
                 "select drop_location as location_name, 'drop' as location_type, * from ride",
    "bronze_location": first_per(
        f"location_name, location_type, booking_id, {LINEAGE}", "location_name, location_type, booking_id",
        "both_ends", "location_name is not null"),
    "bronze_booking_status": named("booking_status_name", "booking_status"),
    "bronze_payment_method": named("payment_method_name", "payment_method"),
    "bronze_booking": first_per(f"{BOOKING}, {LINEAGE}", "booking_id", "ride", "booking_id is not null"),
    "bronze_ride": first_per(
        f"booking_id, ride_distance, driver_rating, customer_rating, {LINEAGE}", "booking_id", "ride", COMPLETED),
    "bronze_cancelled_ride": first_per(
        f"booking_id, cast(coalesce(cancelled_rides_by_customer, 0) as bigint) as cancelled_rides_by_customer, "
        f"cast(coalesce(cancelled_rides_by_driver, 0) as bigint) as cancelled_rides_by_driver, {LINEAGE}",
        "booking_id", "ride", CANCELLED,
        f"booking_id, cancelled_rides_by_customer, cancelled_rides_by_driver, {LINEAGE}"),
    "bronze_incompleted_ride": first_per(
        f"booking_id, cast(incomplete_rides as bigint) as incomplete_rides, incomplete_rides_reason, {LINEAGE}",
        "booking_id", "ride", "incomplete_rides is not null",
        f"booking_id, incomplete_rides, incomplete_rides_reason, {LINEAGE}"),
    "silver_customer": SEEN.format("bronze_booking"),
    "silver_vehicle_type": dimension("vehicle_type_id", "select vehicle_type_name as name from bronze_vehicle_type"),
    "silver_location": dimension("location_id", "select location_name as name from bronze_location"),
    "silver_booking_status": dimension(
        "booking_status_id", "select booking_status_name as name from bronze_booking_status"),
    "silver_payment_method": dimension(
        "payment_method_id", "select payment_method_name as name from bronze_payment_method"),
    "month_booking": "select b.booking_id, b.customer_id, v.vehicle_type_id, pl.location_id as pickup_location_id, "
                     "dl.location_id as drop_location_id, s.booking_status_id, m.payment_method_id, b.booking_value, "
                     "b.date, b.time, b.extraction_month from bronze_booking b "
                     "left join silver_vehicle_type v on v.name = b.vehicle_type "
                     "left join silver_location pl on pl.name = b.pickup_location "
                     "left join silver_location dl on dl.name = b.drop_location "
                     "left join silver_booking_status s on s.name = b.booking_status "
                     "left join silver_payment_method m on m.name = b.payment_method",
    "silver_booking": "select * exclude (extraction_month) from month_booking",
    "silver_ride": "select booking_id, ride_distance, driver_rating, customer_rating from bronze_ride",
    "silver_cancelled_ride": "select row_number() over (order by booking_id nulls first, extraction_month) "
                             "as cancellation_id, booking_id, cancelled_rides_by_customer, "
                             "cancelled_rides_by_driver from bronze_cancelled_ride",
    "silver_incompleted_ride": "select row_number() over (order by booking_id nulls first, extraction_month) "
                               "as incompleted_id, booking_id, incomplete_rides, incomplete_rides_reason "
                               "from bronze_incompleted_ride",
    "gold_daily_booking_summary": daily("silver_booking"),
    "gold_customer_analytics": customers("silver_booking"),
    "gold_location_analytics": locations("silver_booking"),
    "sales": "select l_orderkey as order_id, l_partkey as product_id, l_suppkey as seller_id, "
             "l_extendedprice as value, cast(year(l_shipdate) as bigint) as year, "
             "cast(month(l_shipdate) as bigint) as month, l_returnflag = 'R' as is_change, "
             "o_custkey as customer_id, c_mktsegment as channel "
             "from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey",
    "company": f"select year, month, count(distinct order_id) as all_orders, {total('value')} as all_revenue "
               f"from sales group by year, month",
    "categories": "select customer_id, case when count(distinct order_id) = 1 then 'ocasional' else 'frecuente' end "
                  "as category, year, month from sales group by customer_id, year, month",
}
NAMES = re.compile(r"\b(" + "|".join(BLOCKS) + r")\b")


def statement(body: str) -> str:
    """The query with the blocks it needs, in order."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        for name in NAMES.findall(todo.pop()):
            if name not in needed:
                needed.add(name)
                todo.append(BLOCKS[name])
    blocks = ", ".join(f"{name} as ({sql})" for name, sql in BLOCKS.items() if name in needed)
    return f"with {blocks} {body}" if blocks else body


def _clean(column: str) -> str:
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"trim(replace({column}, '\"', ''), {blanks}) as {column}"


def _spelled(name: str, kind: str) -> str:
    """A text column as the untidy source spells it."""
    if name in ("booking_id", "customer_id"):
        return f"'\"' || {name} || '\"' as {name}"
    return name if kind in ("double", "date") else f"' ' || {name} || chr(9) || ' ' as {name}"


def _listing(layers: list[str]) -> str:
    lines = []
    for layer in layers:
        for table, ddl in TABLES[layer].items():
            lines.append(f"select '{layer}' as layer, '{table}' as \"table\", '{layer}_{table}' as view_name, "
                         f"'{layer}.{table}' as full_name, count(*) as rows, "
                         f"cast({len(ddl.split(', '))} as bigint) as columns from {layer}_{table}")
    return " union all ".join(lines)


DESCRIBED = [("vehicle_type_id", "vehicle_type_id"), ("pickup_location_id", "pickup_location_id"),
             ("drop_location_id", "drop_location_id"), ("booking_status_id", "booking_status_id"),
             ("payment_method_id", "payment_method_id"), ("booking_value", "booking_value"),
             ("date", "date_diff('day', date '1970-01-01', date)")]


def _described(name: str, value: str) -> str:
    v = f"cast({value} as double)"
    return (f"select '{name}' as column_name, count({v}) as count, round(avg({v}), 6) as mean, "
            f"round(stddev_samp({v}), 6) as std, min({v}) as min, round(quantile_cont({v}, 0.25), 6) as q25, "
            f"round(quantile_cont({v}, 0.5), 6) as q50, round(quantile_cont({v}, 0.75), 6) as q75, max({v}) as max from silver_booking")


def _profiled(name: str, kind: str) -> str:
    return (f"select '{name}' as column_name, '{kind.lower()}' as data_type, count({name}) as non_null_count, "
            f"count(*) - count({name}) as null_count from bronze_booking")


def _summed(key: str, value: str, alias: str) -> str:
    amount = total(value) if value == "total_revenue" else f"cast(sum({value}) as bigint)"
    return f"select {key}, {amount} as {alias} from gold_daily_booking_summary group by {key}"


def _shares(mart: str, entity: str) -> str:
    return (f"select {entity}, orders, revenue, orders * 100.0::double / cast(all_orders as double) as orders_percent, "
            f"revenue * 100.0::double / all_revenue as revenue_percent, m.year, m.month "
            f"from ({mart}) m join company c on m.year = c.year and m.month = c.month")


def _bodies() -> dict[str, str]:
    in_month = f"extraction_month = '{MONTH}'"
    bodies = {
        "src_prepare": f"select {RIDE_COLUMNS}, {LINEAGE} from ride",
        "src_clean_text": "select doc_id, " + ", ".join(map(_clean, ("text", "lang", "source"))) + " from documents",
        "src_csv_records": """select doc_id, md5(coalesce(text, '')) as text_md5, if(doc_id % 7 = 3, null, lang) as lang,
            if(doc_id % 7 = 3, null, source) as source, doc_id % 7 = 5 as too_long from documents""",
        "src_na_normalise": "select " + ", ".join(
            _spelled(name, kind) for _, name, kind in SOURCE_COLUMNS) + " from ride",
        "src_month_slice": f"select booking_id, date, time, booking_status, booking_value, {LINEAGE} from ride "
                           f"where {in_month}",
        "store_read_projected": f"select booking_id, customer_id, booking_value from bronze_booking "
                                f"where {in_month} and booking_value > 1000",
        "store_upsert": "select booking_id, extraction_month, booking_status, booking_value, date from (select *, "
                        "row_number() over (partition by booking_id order by extraction_month desc) as newest "
                        "from bronze_booking) where newest = 1",
        "store_as_of_month": customers(
            f"(select * from bronze_booking where extraction_month <= '{AS_OF}')",
            "(" + SEEN.format(f"(select * from bronze_booking where extraction_month <= '{AS_OF}')") + ")"),
        "cat_table_listing": _listing(list(TABLES)),
    }
    bodies |= {"store_upsert_months": bodies["store_upsert"], "key_stable_customers": f"""
        select row_number() over (order by first > '{FIRST_SEEN}', name) as customer_key, name
        from (select customer_id as name, min(extraction_month) as first from bronze_booking where customer_id is not null group by 1)"""}
    bodies["report_retention_span"] = " union all ".join(f"""
        select '{a}..{b}' as span, '{c}..{d}' as later_span, count(*) filter (early) as customers, count(*) filter (late) as later_customers,
               count(*) filter (early and late) as came_back, 100.0 * count(*) filter (early and late) / nullif(count(*) filter (early), 0) as retention_percent
        from (select customer_id, bool_or(extraction_month between '{a}' and '{b}') as early, bool_or(extraction_month between '{c}' and '{d}') as late
              from bronze_booking where customer_id is not null group by 1)""" for a, b, c, d in SPANS)
    bodies |= {"inc_customer": "select * from silver_customer"}
    bodies |= {f"inc_{t}": f"select * from gold_{t}" for t in TABLES["gold"]}
    bodies |= {f"bronze_{t}": f"select * from bronze_{t}" for t in TABLES["bronze"]}
    bodies |= {f"silver_{t}": f"select * from silver_{t}" for t in TABLES["silver"]}
    bodies |= {f"gold_{t}": f"select * from gold_{t}" for t in TABLES["gold"]}
    bodies |= {
        "silver_ride_times": first_per("booking_id, avg_vtat, avg_ctat, ride_distance, driver_rating, customer_rating",
                                       "booking_id", "ride", COMPLETED),
        "silver_cancellation_actor": first_per(
            "booking_id, case when cancelled_rides_by_customer > 0 then 'Customer' when cancelled_rides_by_driver > 0 "
            "then 'Driver' end as ride_cancelled_by, coalesce(customer_cancel_reason, driver_cancel_reason) "
            "as cancellation_reason", "booking_id", "ride", CANCELLED,
            "booking_id, ride_cancelled_by, cancellation_reason"),
        "gold_daily_booking_summary_by_month": daily("month_booking", "month"),
        "gold_customer_analytics_by_month": customers("month_booking", month="month"),
        "gold_location_analytics_by_month": locations("month_booking", "month"),
        "dash_months": "select distinct extraction_month from bronze_booking order by extraction_month desc",
        "dash_filter_direct": f"select * from bronze_ride where {in_month}",
        "dash_filter_booking_id": f"select * from silver_ride where booking_id in "
                                  f"(select booking_id from bronze_booking where {in_month})",
        "dash_filter_customer_id": f"select * from gold_customer_analytics where customer_id in "
                                   f"(select customer_id from bronze_booking where {in_month})",
        "dash_filter_location_name": f"select * exclude (location_id) from gold_location_analytics where name in "
                                     f"(select pickup_location from bronze_booking where {in_month} union "
                                     f"select drop_location from bronze_booking where {in_month})",
        "dash_recalc_daily_summary": f"select date, vehicle_type as vehicle_type_name, booking_status as "
                                     f"booking_status_name, count(booking_id) as total_bookings, "
                                     f"{total('booking_value')} as total_revenue, "
                                     f"{ratio(total('booking_value'), 'count(booking_id)')} as avg_booking_value "
                                     f"from bronze_booking where {in_month} and date is not null and vehicle_type "
                                     f"is not null and booking_status is not null group by all",
        "dash_kpis": f"select cast(sum(total_bookings) as bigint) as total_bookings, {total('total_revenue')} as "
                     f"total_revenue, {ratio(total('total_revenue'), 'sum(total_bookings)')} as avg_booking_value, "
                     f"count(distinct date) as unique_dates from gold_daily_booking_summary",
        "dash_daily_trend": _summed("date", "total_bookings", "total_bookings"),
        "dash_daily_revenue": _summed("date", "total_revenue", "total_revenue"),
        "dash_status_breakdown": _summed("booking_status_name", "total_bookings", "total_bookings"),
        "dash_vehicle_breakdown": _summed("vehicle_type_name", "total_bookings", "total_bookings"),
        "dash_top_customers": "select customer_id, total_bookings, total_spent from gold_customer_analytics "
                              "order by total_bookings desc nulls last, customer_id limit 10",
        "dash_top_locations": "select name, pickups, dropoffs, total_activity from gold_location_analytics "
                              "order by total_activity desc, name limit 10",
        "profile_table_size": "select count(*) as row_count, cast(12 as bigint) as column_count from silver_booking",
        "profile_describe": " union all ".join(_described(*c) for c in DESCRIBED),
        "profile_columns": " union all ".join(
            _profiled(*c.split(" ")) for c in TABLES["bronze"]["booking"].split(", ")),
        "sql_list_gold": _listing(["gold"]),
        "sql_daily_summary": "select * from gold_daily_booking_summary "
                             "order by date, vehicle_type_name, booking_status_name limit 100",
        "sql_top_customers": "select customer_id, total_bookings, total_spent, avg_booking_value "
                             "from gold_customer_analytics order by total_bookings desc nulls last, customer_id limit 10",
        "sql_revenue_by_vehicle": f"select vehicle_type_name, cast(sum(total_bookings) as bigint) as total_bookings, "
                                  f"{total('total_revenue')} as total_revenue, round(avg(avg_booking_value), 6) as "
                                  f"avg_booking_value from gold_daily_booking_summary group by vehicle_type_name",
        "sql_bookings_by_status": f"select booking_status_name, cast(sum(total_bookings) as bigint) as total_bookings, "
                                  f"{total('total_revenue')} as total_revenue from gold_daily_booking_summary "
                                  f"group by booking_status_name",
        "sql_top_locations": "select name, pickups, dropoffs, total_activity, avg_booking_value "
                             "from gold_location_analytics order by total_activity desc, name limit 15",
        "sql_daily_trends": f"select date, cast(sum(total_bookings) as bigint) as daily_bookings, "
                            f"{total('total_revenue')} as daily_revenue from gold_daily_booking_summary group by date",
        "sql_customers": "select * from silver_customer order by customer_id limit 100",
        "sql_raw_bookings": "select * from bronze_booking order by booking_id, extraction_month limit 50",
        "sql_revenue_by_vehicle_short": f"select vehicle_type_name, {total('total_revenue')} as revenue, "
                                        f"cast(sum(total_bookings) as bigint) as bookings "
                                        f"from gold_daily_booking_summary group by vehicle_type_name",
        "sql_top_spenders": "select customer_id, total_bookings, total_spent from gold_customer_analytics "
                            "order by total_spent desc nulls last, customer_id limit 10",
        "verify_partition_count": f"select '{MONTH}' as extraction_month, count(*) as rows from bronze_booking "
                                  f"where {in_month}",
        "verify_date_range": f"select count(*) as rows, min(date) as min_date, max(date) as max_date "
                             f"from bronze_booking where {month_range('date')}",
        "verify_cardinalities": " union all ".join(
            f"select '{d}' as dimension, count(*) as rows from silver_{d}"
            for d in ("customer", "vehicle_type", "location")),
        "verify_vehicle_ids": "select name, vehicle_type_id from silver_vehicle_type",
        "verify_month_totals": f"select count(*) as summary_rows, {total('total_revenue')} as total_revenue, "
                               f"cast(coalesce(sum(total_bookings), 0) as bigint) as total_bookings, "
                               f"{ratio(total('total_revenue'), 'sum(total_bookings)')} as avg_booking_value "
                               f"from gold_daily_booking_summary where {month_range('date')}",
        "verify_top_vehicle_revenue": f"select vehicle_type_name, {total('total_revenue')} as total_revenue "
                                      f"from gold_daily_booking_summary where {month_range('date')} "
                                      f"group by vehicle_type_name order by total_revenue desc, vehicle_type_name limit 5",
        "verify_top_spenders": "select customer_id, total_bookings, total_spent, avg_booking_value "
                               "from gold_customer_analytics order by total_spent desc nulls last, customer_id limit 10",
        "verify_top_locations": "select name, pickups, dropoffs, total_activity from gold_location_analytics "
                                "order by total_activity desc, name limit 10",
        "verify_partition_summary": f"select extraction_month, count(*) as rows, extraction_month = '{MONTH}' as "
                                    f"is_current from bronze_booking group by extraction_month",
        "report_mom_growth": "select extraction_month, bookings, previous_bookings, (bookings - previous_bookings) * "
                             "100.0::double / nullif(cast(previous_bookings as double), 0) as growth_percent from "
                             "(select m.extraction_month, m.bookings, p.bookings as previous_bookings from "
                             "(select extraction_month, count(booking_id) as bookings from bronze_booking group by 1) m "
                             "left join (select extraction_month, count(booking_id) as bookings from bronze_booking "
                             "group by 1) p on cast(p.extraction_month || '-01' as date) + interval 1 month = "
                             "cast(m.extraction_month || '-01' as date))",
        "report_first_booking_cohort": f"select strftime(first_booking_date, '%Y-%m') as cohort_month, "
                                       f"count(customer_id) as customers, cast(sum(total_bookings) as bigint) as "
                                       f"total_bookings, {total('total_spent')} as total_spent "
                                       f"from gold_customer_analytics where first_booking_date is not null group by 1",
        "report_daily_revenue": f"select date, {total('total_revenue')} as total_revenue "
                                f"from gold_daily_booking_summary where {month_range('date')} group by date",
        "report_peak_hours": "select cast(substr(time, 1, 2) as bigint) as hour, count(*) as bookings "
                             "from silver_booking group by 1",
        "report_revenue_share": f"select vehicle_type_name, {total('total_revenue')} as total_revenue, "
                                f"{total('total_revenue')} * 100.0::double / (select {total('total_revenue')} from "
                                f"gold_daily_booking_summary) as share_percent from gold_daily_booking_summary "
                                f"group by vehicle_type_name",
        "report_bookings_per_month": "select strftime(date, '%Y-%m') as month, count(booking_id) as bookings "
                                     "from silver_booking group by 1",
        "mart_product_changes": "select product_id, p_name as product_name, count(*) as changes, year, month "
                                "from sales join part on p_partkey = product_id where is_change "
                                "group by product_id, p_name, year, month",
        "mart_referral_revenue": f"select channel, s.year, s.month, {total('value')} as revenue, {total('value')} * "
                                 f"100.0::double / any_value(all_revenue) as revenue_percent from sales s join company c "
                                 f"on c.year = s.year and c.month = s.month group by channel, s.year, s.month",
        "mart_monthly_growth": "select c.year, c.month, c.all_revenue as revenue, c.all_revenue * 100.0::double / "
                               "nullif(p.all_revenue, 0) - 100 as growth_percent from company c left join company p "
                               "on p.year * 12 + p.month + 1 = c.year * 12 + c.month",
        "mart_customer_sales": _shares(
            f"select customer_id, count(distinct order_id) as orders, {total('value')} as revenue, year, month "
            f"from sales group by customer_id, year, month", "customer_id"),
        "mart_customer_category": "select * from categories",
        "mart_retention": "select count(*) as customers, count(*) filter (category = 'frecuente') as frequent, "
                          "count(*) filter (category = 'ocasional') as occasional, count(*) filter (category = "
                          "'frecuente') * 100.0::double / cast(count(*) as double) as frequent_percent, year, month "
                          "from categories group by year, month",
        "mart_branch_sales": _shares(
            f"select n_name as branch, count(distinct order_id) as orders, {total('value')} as revenue, year, month "
            f"from sales join supplier on s_suppkey = seller_id join nation on n_nationkey = s_nationkey "
            f"group by n_name, year, month", "branch"),
    }
    return bodies


def all_expected_sql() -> dict[str, str]:
    return {name: statement(body) for name, body in _bodies().items()}
