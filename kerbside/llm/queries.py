"""The registered queries of this part, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (
    conversation_trie, decontamination, language_model, lattice_sampling, learned_partitions, license_scan, line_dedup, quality,
    simhash, spelling_variants, syncmers, token_counts, token_shards)
from kerbside.llm.expected_sql import EXPECTED_SQL
from kerbside.llm.scratch import scratch_path
from kerbside.sources.ride_star import read_table

PROBES = 44  # parts of 64 that a query of op9 looks into
__all__ = ["EXPECTED_SQL", "QUERIES"]
Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    voters = quality.fit(docs, labels.where(language_model.remainder("doc_id", 3) != 1))
    held_out = docs.withColumn("held_out", language_model.remainder("doc_id", 3) == 1)
    return quality.scored(held_out, voters, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("hamming").withColumn("similarity", F.round("similarity", 9))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that every distinct text is encoded."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                     scratch_path(spark, "token-cache"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples by their ids, each decoded again."""
    samples = lattice_sampling.sampled_segmentations(read_table(spark, sf_dir, "documents"),
                                                     public_tokenizers.path("piece_bpe_32k.model"), k=2, decode=True)
    return samples.withColumns({"ids_crc32": F.crc32("ids"), "text_crc32": F.crc32("text")}).drop("ids", "text")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_fingerprint_groups(read_table(spark, sf_dir, "documents"), size=3, radius=2)


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    shards = token_shards.write_token_shards(docs, scratch_path(spark, "token-shards"),
                                             public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return shards.read(docs).select("doc_id", "start", F.col("n_ids").alias("n_tokens"),
                                    token_shards.ids_crc32("ids").alias("ids_crc32"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.license_matches(read_table(spark, sf_dir, "documents"), license_scan.templates(spark))
    return found.withColumn("containment", F.round("containment", 9))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read_table(spark, sf_dir, "documents"))


def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    index = learned_partitions.build_index(vectors)
    return index.search(vectors.where(F.col("vec_id") % 50 == 0), k=5, probes=PROBES)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = language_model.remainder("doc_id", 7) == 2
    return language_model.score(docs, language_model.train(docs.where(~held_out)), held_out=held_out)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(read_table(spark, sf_dir, "conversations"), every=5, head=9)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_token_shards": op6_token_shards,
    "op7_license_scan": op7_license_scan,
    "op8_line_dedup": op8_line_dedup,
    "op9_nearest": op9_nearest,
    "op10_lm_score": op10_lm_score,
    "op11_fingerprints": op11_fingerprints,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_spelling_variants": op13_spelling_variants,
}
