"""Cleaning pipeline over ``documents``: every stage works on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import decontamination, lattice_sampling, line_dedup, near_duplicates, quality
from kerbside.llm.scratch import stored
from kerbside.sources.ride_star import read_table


SCORE = "kerbside_quality_score"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled documents vote for; the voters come from the unfiltered table."""
    voters = quality.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    scored = quality.scored(docs, voters, docs.columns, out=SCORE)
    return scored.where(F.col(SCORE) >= 0.5).select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three or more documents hold, but for the largest of these."""
    return line_dedup.deduplicated(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.deduplicated(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontamination.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, with their piece ids."""
    return lattice_sampling.sampled_segmentations(docs, public_tokenizers.path("piece_bpe_32k.model"), k=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("sentencepiece", encoded),
]

#: SQL has no SentencePiece, no SimHash and no matrix products; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
