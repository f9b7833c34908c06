"""Token counts through a cache keyed by content digest and tokenizer version.

A text is encoded only if no row of the cache has its digest under this tokenizer, and then once however often
it occurs.  Texts move in one shuffle, to the rows chosen to stand for their digest; all else moves digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.chunked_encoder import worker_encoder
from kerbside.llm.scratch import stored
from kerbside.sources.files import path_exists

_CACHE = "digest binary, n_tokens long"
_BATCH = 256  # texts encoded together


def content_digest(text: Column) -> Column:
    """SHA-256 of the normalised text: null is empty, and nothing else may change, as byte-level ids tell all bytes apart."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _encode(tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer.value)
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH):
                part = batch.slice(start, _BATCH)
                ids = encoder.payloads([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("digest"), pa.array([len(i) // encoder.width for i in ids], pa.int64())],
                    names=["digest", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer_file: str, cache: str, text: str = "text", key: str = "doc_id",
                 limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row; the cache folder gains the texts it had not.

    Null texts count as empty, repeated rows and null ids are rows like any other, and an empty table gives an
    empty result.  Appends are whole or absent (one committed write); two runs at once may add a digest twice,
    which lookups pass over.
    """
    session = docs.sparkSession
    model = Path(tokenizer_file).read_text(encoding="utf-8")
    version = hashlib.sha256(model.encode()).hexdigest()
    folder = f"{cache.rstrip('/')}/tokenizer={version}"
    own = docs.select(F.col(key).alias("doc_id"), content_digest(F.col(text)).alias("digest"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))
    keyed = stored(own.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")

    # One row stands for each missing digest; joining on both columns spreads the copies of a hot text.
    missing = keyed.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    if path_exists(session, folder):
        missing = missing.join(session.read.schema(_CACHE).parquet(folder), "digest", "left_anti")
    chosen = stored(missing, "missing").hint("shuffle_hash")
    texts = own.join(chosen.withColumnRenamed("digest", "d").withColumnRenamed("doc_id", "i"),
                     (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i")), "left_semi")
    counted = texts.select("digest", "text").mapInArrow(_encode(session.sparkContext.broadcast(model)), _CACHE)
    counted.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")).write.mode("append").parquet(folder)

    # Stored, so that the last join's shuffle of the rows can be split at a frequent digest.
    known = stored(session.read.schema(_CACHE).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "known")
    return keyed.join(known, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
