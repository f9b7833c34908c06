"""Operators against brute force on small frames, with hot keys and nulls."""

import random
import re
import statistics
from datetime import date

import numpy as np
from conftest import SF_DIR, plan_of, rows_of
from pyspark.sql import functions as F

from kerbside.functions.money import money_avg, money_sum
from kerbside.functions.text import NA_TOKENS, clean_text, na_to_null, to_date, to_number
from kerbside.operators.dense_id import dense_id
from kerbside.operators.keep_first import keep_first
from kerbside.operators.lookup import lookup
from kerbside.operators.profile import column_profile, describe, table_size
from kerbside.operators.quantiles import exact_quantiles
from kerbside.operators.settle import settle
from kerbside.operators.spread import SLICE, deal, spread
from kerbside.operators.upsert import insert_new, replaced, upsert
from kerbside.plans import bronze
from kerbside.schemas import SOURCE_COLUMNS
from kerbside.session import METHOD_CONF, shared_folder
from kerbside.sources.files import child_names
from kerbside.sources.ride_csv import ORDER_PREFIX, REPEATED, stamp
from kerbside.sources.ride_star import raw_rides, ride_source
from kerbside.sources.warehouse import Warehouse


def hot_rows(n=600, seed=1):
    """A third of the rows share one key, another third has none."""
    rng = random.Random(seed)
    return [(["hot", None, f"k{rng.randrange(20)}"][i % 3], rng.randrange(1000), i) for i in range(n)]


def test_keep_first_keeps_the_first_row_of_hot_and_null_keys(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(7)
    first = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        first.setdefault(row[0], row)
    assert rows_of(keep_first(df, ["k"], ["o", "v"])) == sorted(first.values(), key=str)


def test_keep_first_limits_each_key_before_the_shuffle(spark):
    df = spark.createDataFrame(hot_rows(), "k string, o int, v int")
    plan = plan_of(keep_first(df, ["k"], ["o", "v"]))
    assert "Partial" in plan[plan.index("Exchange"):]


def test_dense_id_is_one_to_n_in_order(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, o int, v int").repartition(9)
    got = [tuple(r) for r in dense_id(df, "id", ["k", "o", "v"]).orderBy("id").collect()]
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert got == [(i, *row) for i, row in enumerate(expected, 1)]


def test_dense_id_of_nothing(spark):
    assert dense_id(spark.createDataFrame([], "k string"), "id", ["k"]).collect() == []


def test_dense_id_never_uses_one_task(spark):
    df = spark.range(1000).repartition(4)
    assert "SinglePartition" not in plan_of(dense_id(df, "n", ["id"]))


def test_lookup_does_not_multiply_rows(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("x", 4)], "name string, v int")
    dim = spark.createDataFrame([("a", 10), ("a", 11), ("b", 20), (None, 30)], "name string, id long")
    got = rows_of(lookup(fact, "name", dim, "name", "id", "out"), "v", "out")
    assert got == [(1, 11), (2, 20), (3, None), (4, None)]


def test_upsert_takes_the_newest_update(spark):
    base = spark.createDataFrame([("a", 1, "old"), ("b", 1, "old"), (None, 1, "old")], "k string, t int, v string")
    updates = spark.createDataFrame(
        [("b", 2, "mid"), ("b", 3, "new"), ("c", 2, "new"), (None, 5, "new")], "k string, t int, v string")
    got = rows_of(upsert(base, updates, ["k"], [F.desc("t")]))
    assert got == sorted([("a", 1, "old"), ("b", 3, "new"), ("c", 2, "new"), (None, 5, "new")], key=str)


def test_insert_new_skips_known_keys_also_null_ones(spark):
    stored = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    rows = spark.createDataFrame([("a", 9), (None, 9), ("b", 9)], "k string, v int")
    assert rows_of(insert_new(stored, rows, ["k"])) == [("b", 9)]


def test_exact_quantiles_match_linear_interpolation(spark):
    rng = random.Random(3)
    hot = [7.0] * 400 + [rng.uniform(0, 100) for _ in range(801)]
    few = [1.0, 2.0, 4.0] + [None] * (len(hot) - 3)
    df = spark.createDataFrame(list(zip(hot, few)), "hot double, few double").repartition(6)
    probabilities = {"p0": 0.0, "q25": 0.25, "q50": 0.5, "q90": 0.9, "p100": 1.0}
    got = {r["column_name"]: r for r in exact_quantiles(df, ["hot", "few"], probabilities).collect()}
    for name, values in (("hot", hot), ("few", few[:3])):
        for key, p in probabilities.items():
            assert abs(got[name][key] - np.quantile(values, p)) < 1e-9, (name, key)


def test_describe(spark):
    values = [1.0, 2.0, 3.5, 10.0, None]
    days = [date(1970, 1, d) for d in (2, 3, 4, 5, 6)]
    df = spark.createDataFrame(list(zip(values, days, "abcde")), "v double, d date, t string")
    got = {r["column_name"]: r.asDict() for r in describe(df).collect()}
    assert set(got) == {"v", "d"}
    assert got["v"]["count"] == 4 and got["v"]["min"] == 1.0 and got["v"]["max"] == 10.0
    assert abs(got["v"]["std"] - statistics.stdev(values[:4])) < 1e-9
    assert got["v"]["q50"] == 2.75
    assert got["d"]["mean"] == 3.0 and got["d"]["q75"] == 4.0


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    assert rows_of(column_profile(df)) == [("a", "int", 2, 1), ("b", "string", 1, 2)]
    assert rows_of(table_size(df)) == [(3, 2)]


def test_money_does_not_depend_on_order(spark):
    rng = random.Random(5)
    values = [round(rng.uniform(0, 1e5), 2) for _ in range(2000)]
    sums = set()
    for parts in (1, 3, 8):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        sums.add(tuple(df.agg(money_sum(F.col("v")), money_avg(F.col("v"))).first()))
    total = sum(round(v * 100) for v in values) / 100.0
    assert sums == {(total, total / len(values))}


def test_money_of_nothing_is_zero_and_its_mean_null(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert rows_of(df.groupBy("k").agg(money_sum(F.col("v")).alias("s"), money_avg(F.col("v")).alias("a"))) == [("a", 0.0, None)]


def test_missing_value_tokens(spark):
    texts = [*NA_TOKENS, " NA", "na", "0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(na_to_null(F.col("t"))).collect()] == [None] * len(NA_TOKENS) + [" NA", "na", "0"]


def test_clean_text_strips_what_python_strips(spark):
    texts = [' "CNR1" ', "\t　x y\xa0\n", '""', "a​b", ' " z " ', "\u0085é "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(clean_text(F.col("t"))).collect()] == [t.replace('"', "").strip() for t in texts]


def test_numbers_and_dates(spark):
    df = spark.createDataFrame([("1.50", "2024-02-29"), ("x", "2024-13-01"), (None, None), ("1e3", "2024"),
                                ("-2", "2024-3-5")], "n string, d string")
    assert [tuple(r) for r in df.select(to_number(F.col("n")), to_date(F.col("d"))).collect()] == [
        (1.5, date(2024, 2, 29)), (None, None), (None, None), (1000.0, None), (-2.0, None)]


def test_date_spellings(spark):
    good = ["2024-03-01", "2024/03/01", "2024-03-01 00:00:00", "2024-03-01T12:30", "2024-03-01 23:59:59.123"]
    bad = ["2024-03/01", "2024-02-30", "2024-03-01 later", "01-03-2024", ""]
    df = spark.createDataFrame([(t,) for t in good + bad], "d string")
    assert [r[0] for r in df.select(to_date(F.col("d"))).collect()] == [date(2024, 3, 1)] * 5 + [None] * 5


def test_spread_is_the_callers_choice(spark):
    assert spread(spark.range(0, 10, 1, 3), None).rdd.getNumPartitions() == 3
    assert spread(spark.range(0, 10, 1, 1), 5).rdd.getNumPartitions() == 5


def test_small_amounts_count(spark):
    df = spark.createDataFrame([(0.004,)] * 1000 + [(0.125,), (-0.001,), (None,)], "v double")
    assert tuple(df.agg(money_sum(F.col("v")), money_avg(F.col("v"))).first()) == (4.124, 4.124 / 1002)
    wide = spark.createDataFrame([(1e12 + 0.25,)] * 500 + [(-3e11,)], "v double")
    assert wide.agg(money_sum(F.col("v"))).first()[0] == 500 * (1e12 + 0.25) - 3e11
    odd = spark.createDataFrame([(1.0,), (float("inf"),)], "v double")
    assert odd.agg(money_sum(F.col("v"))).first()[0] == float("inf")


def test_described_values_leave_nothing_behind(spark):
    describe(spark.range(100)).collect()
    assert [n for n in child_names(spark, f"{shared_folder(spark)}/kerbside") if n.startswith("quantiles")] == []


def booking_rows(spark, n):
    """Rows as prepared for Bronze: bookings that repeat in a month or in others, that have no id, and odd ones out."""
    i = F.col("id")
    text = F.concat(F.lit("t"), (i % 5).cast("string"))
    values = {"date": F.date_add(F.lit("2024-01-01").cast("date"), (i % 40).cast("int")),
              "booking_id": F.when(i % 11 != 0, F.concat(F.lit("b"), F.least(i, F.lit(60)).cast("string"))),
              "booking_status": F.element_at(F.array(F.lit("Completed"), F.lit("Incomplete"), F.lit(None)), (i % 3 + 1).cast("int"))}
    rows = spark.range(n).select(
        i, *[values.get(name, F.when(i % 7 != 0, text if kind == "string" else (i % 4).cast(kind))).alias(name)
             for _, name, kind in SOURCE_COLUMNS], F.lit("file").alias("source_file"), i.alias(f"{ORDER_PREFIX}0"))
    return stamp(rows.drop("id"), None)


def test_extracts_rank_repeated_bookings_only(spark):
    rows = settle(booking_rows(spark, 200), "rows")
    repeated = settle(bronze.repeated_bookings(rows), "repeated")
    for name in bronze.EXTRACTS:
        some = bronze.extract(name, rows, repeated)
        assert rows_of(some) == rows_of(bronze.extract(name, rows)), name
        # All but the join's small side stay where they are, up to the repeated ones, which alone are ranked.
        plan = plan_of(some)
        assert plan.count("LeftAnti") == 1 and plan.index("LeftAnti") < plan.index("LeftSemi"), name
        assert not re.search("Exchange hash|Window|Sort", plan[:plan.index("LeftAnti")].split("+- Union")[-1]), name
    assert bronze.repeated_bookings(rows.limit(0)).count() == 0


def test_rows_dealt_by_month_are_stored_without_a_shuffle(spark, folder):
    rows = settle(booking_rows(spark, 200), "rows")
    months = [r[0] for r in rows.select("extraction_month").distinct().collect()]
    stored = {}
    for dealt in (False, True):
        store = Warehouse(spark, f"{folder}/{dealt}")
        assert store.replace_months(bronze.extract("booking", rows), "booking", months, dealt=dealt) == len(stored.setdefault(
            dealt, rows_of(store.read("bronze", "booking"))))
    assert stored[True] == stored[False] and stored[True]


def test_sales_lines_by_month_are_the_same_rows(spark):
    plain, dealt = (ride_source(spark, SF_DIR, by_month=by_month) for by_month in (False, True))
    assert "REBALANCE" in plan_of(dealt) and "REBALANCE" not in plan_of(plain)
    assert dealt.columns == plain.columns and dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()


def test_marked_bookings_are_those_that_repeat(spark, folder):
    """Lines of one booking meet where they are dealt by month: no further shuffle, and no join with the repeated ones."""
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    i = F.col("l_orderkey")
    odd = lines.where(i % 3 == 0).withColumn("l_shipdate", F.when(i % 5 == 0, F.add_months("l_shipdate", 1).cast("timestamp_ntz")).when(
        i % 7 > 0, F.col("l_shipdate")))
    lines.unionByName(odd).write.parquet(f"{folder}/lineitem.parquet")
    for name in ("nation", "customer", "supplier", "part", "orders"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    plain = settle(stamp(ride_source(spark, folder), None), "rows")
    source = ride_source(spark, folder, mark=True)
    plan = plan_of(source)
    assert plan.count("Window [count") == 1 and plan.index("Window [count") < plan.index("REPARTITION")
    marked = settle(stamp(source, None), "marked")
    assert marked.drop(REPEATED).exceptAll(plain).isEmpty() and plain.exceptAll(marked.drop(REPEATED)).isEmpty()
    hashes = {r[0] for r in bronze.repeated_bookings(plain).collect()}
    key = F.xxhash64("booking_id", "extraction_month")
    assert {(r[0] in hashes) == r[1] for r in marked.where("booking_id is not null").select(key, REPEATED).collect()} == {True}
    assert marked.where(f"booking_id is null and not {REPEATED}").isEmpty() and not marked.where(f"not {REPEATED}").isEmpty()
    for name in bronze.EXTRACTS:
        some = bronze.extract(name, marked, F.col(REPEATED))
        assert rows_of(some) == rows_of(bronze.extract(name, plain)), name
        assert "Join" not in plan_of(some), name


def test_large_months_are_dealt_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr("kerbside.operators.spread.ROWS_A_TASK", 100)
    rows = spark.range(1000).select((F.col("id") % 2).cast("string").alias("month"), "id")
    dealt = deal(rows, "month", F.col("id"), [500, 500])
    assert "hashpartitioning(month" in plan_of(dealt) and ", 10)" in plan_of(dealt)
    assert {n for _, n in dealt.groupBy("month").agg(F.count_distinct(SLICE)).collect()} == {5}
    assert deal(rows.limit(0), "month", F.col("id"), []).count() == 0


def test_long_generated_methods_are_left_to_the_jit_in_pieces(spark):
    spark.conf.unset(METHOD_CONF)
    raw_rides(spark, SF_DIR)
    assert int(spark.conf.get(METHOD_CONF)) <= 8000
    spark.conf.set(METHOD_CONF, 4000)
    raw_rides(spark, SF_DIR)
    assert spark.conf.get(METHOD_CONF) == "4000"
    spark.conf.unset(METHOD_CONF)


def test_ranked_updates_are_not_ranked_again(spark):
    base = spark.createDataFrame(hot_rows(), "k string, o int, v int")
    updates = spark.createDataFrame([("hot", 1, -1), ("new", 2, -2), ("hot", 3, -3), (None, 4, -4)], "k string, o int, v int")
    newest = settle(keep_first(updates, ["k"], [F.desc("o")]), "newest")
    merged = replaced(base, newest, ["k"])
    assert "Window" not in plan_of(merged)
    assert rows_of(merged) == rows_of(upsert(base, updates, ["k"], [F.desc("o")]))
