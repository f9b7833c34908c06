"""Bitmaps of ids against Python sets, and the SQL box: parameters in, changes out."""

import random

import pytest
from conftest import rows_of

from kerbside.operators.bitmaps import bitmaps, common_to, n_ids, union_of
from kerbside.plans import sql_views


def test_bitmaps_equal_sets(spark):
    rng = random.Random(1)
    rows = [(m, rng.choice([1, 2, 32_768, 32_769, 70_000, rng.randrange(1, 100_000)])) for m in (1, 2, 3) for _ in range(400)] + [(1, None)]
    sets = {m: {i for n, i in rows if n == m and i} for m in (1, 2, 3)}
    stored = bitmaps(spark.createDataFrame(rows, "m int, id long"), "id", ["m"]).cache()
    one, rest = union_of(stored.where("m = 1")), union_of(stored.where("m > 1"))
    assert n_ids(one).first().n == len(sets[1]) and n_ids(rest).first().n == len(sets[2] | sets[3])
    assert n_ids(common_to(one, rest)).first().n == len(sets[1] & (sets[2] | sets[3]))
    assert n_ids(union_of(stored.where("m = 9"))).first().n == 0
    assert rows_of(union_of(stored, ["m"]).groupBy("m").agg({"bucket": "count"}))[0][0] == 1


def test_parameters_are_values(spark):
    spark.createDataFrame([("a", 1), ("x' or '1'='1", 2)], "k string, v int").createOrReplaceTempView("asked")
    result = sql_views.run_sql(spark, "SELECT v FROM asked WHERE k = :k", {"k": "x' or '1'='1"})
    assert result.error is None and rows_of(result.frame) == [(2,)]
    assert rows_of(sql_views.run_sql(spark, "SELECT v FROM asked WHERE v < ?", [2]).frame) == [(1,)]


@pytest.mark.parametrize("text", [
    "DROP VIEW asked", "INSERT INTO asked VALUES ('b', 2)", "CREATE TABLE t USING parquet AS SELECT 1 AS x", "SET spark.sql.ansi.enabled = false",
    "WITH w AS (SELECT 'c' AS k, 3 AS v) INSERT INTO asked SELECT * FROM w", "CACHE TABLE asked", "TRUNCATE TABLE asked"])
def test_commands_come_back_as_an_error(spark, text):
    spark.createDataFrame([("a", 1)], "k string, v int").createOrReplaceTempView("asked")
    result = sql_views.run_sql(spark, text)
    assert result.frame is None and "only queries are run here" in result.error
    assert spark.table("asked").count() == 1 and spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.mark.parametrize("text", ["SHOW VIEWS", "DESCRIBE TABLE asked", "EXPLAIN SELECT 1", "WITH w AS (SELECT 1 AS x) SELECT * FROM w"])
def test_telling_statements_run(spark, text):
    spark.createDataFrame([("a", 1)], "k string, v int").createOrReplaceTempView("asked")
    assert sql_views.run_sql(spark, text).error is None
