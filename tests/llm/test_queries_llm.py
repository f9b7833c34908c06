"""The registered corpus queries: against SQL where there is some, and the pipeline stage by stage."""

import os

import duckdb
import pytest
from conftest import SF_DIR, rows_of
from corpora import no_docs, odd_docs, prose
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from kerbside.llm import near_duplicates, quality
from kerbside.llm.queries import EXPECTED_SQL, QUERIES


@pytest.fixture(scope="module")
def engine():
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings", "conversations"):
        con.execute(f"create view {table} as select * from read_parquet('{SF_DIR}/{table}.parquet')")
    return con


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(EXPECTED_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(EXPECTED_SQL))
def test_same_rows_as_sql(spark, engine, name):
    df = QUERIES[name](spark, SF_DIR)
    result = engine.execute(EXPECTED_SQL[name])
    given = [d[0] for d in result.description]
    assert sorted(given) == sorted(df.columns)
    expected = sorted((tuple(r) for r in result.fetchall()), key=str)
    assert rows_of(df, *given) == expected and expected


def test_stages_one_after_another(spark):
    """Each stage keeps the columns, works on what it is given and decides as its operator does."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in docs.select("doc_id").collect()}, name
        if name == "quality":
            voters = quality.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            assert ids == {r.doc_id for r in quality.scored(docs, voters, ["doc_id"]).where("score >= 0.5").collect()}
        if name == "near_dedup":
            assert len(ids) == near_duplicates.near_duplicate_groups(docs).select("group").distinct().count()
        docs = kept
        sizes.append(docs.count())
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.select("doc_id").distinct().count() == sizes[-1] and last.where(~F.col("round_trip")).count() == 0


def test_labels_agree_with_the_quality_stage(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    kept = corpus_pipeline.good_quality(spark, docs, SF_DIR).join(labels, "doc_id")
    assert kept.where("quality = 1").count() >= 0.97 * labels.where("quality = 1").count()
    assert kept.where("quality = 0").count() <= 0.1 * labels.where("quality = 0").count()


@pytest.mark.parametrize("kind", ["odd", "none"])
def test_stages_on_odd_rows(spark, kind):
    docs = odd_docs(spark, [prose(i, 80) for i in range(5)]) if kind == "odd" else no_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        if name != "sentencepiece":
            assert out.columns == docs.columns, name
        assert out.count() <= 2 * docs.count(), name


def test_no_local_checkpoint_and_no_cache():
    folder = os.path.dirname(quality.__file__)
    for file in os.listdir(folder):
        if file.endswith(".py"):
            with open(f"{folder}/{file}", encoding="utf-8") as source:
                text = source.read()
            assert "localCheckpoint" not in text and ".cache()" not in text and "crossJoin" not in text, file
