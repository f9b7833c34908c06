"""SimHash fingerprints of word shingles, and groups of documents whose fingerprints are near."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.bit_slices import hamming_edges, hex16
from kerbside.llm.components import connected
from kerbside.llm.scratch import stored

SEED = 42
_PIECE = 1 << 16  # hashes unpacked into bits at a time


def words_of(text: str) -> list[bytes]:
    """Runs of other characters than ASCII white space, A-Z lower-cased (bytes methods know ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by a space; fewer words: of them all; none: no hash."""
    if not words:
        return np.empty(0, np.uint64)
    runs = zip(*(words[i:] for i in range(min(size, len(words)))), strict=False)
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """A bit is 1 if set in over half the hashes; no hash: zero."""
    counts = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _PIECE):
        piece = hashes[start:start + _PIECE]
        counts += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [simhash(shingle_hashes(words_of(t or ""), size)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(values, np.uint64).view(np.int64))], names=["doc_id", "fingerprint"])

    return run


def fingerprints(docs: DataFrame, size: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and fingerprint (a long) of every row's whole text; null texts are empty."""
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return own.mapInArrow(_fingerprints(size), "doc_id long, fingerprint long")


def near_fingerprint_groups(docs: DataFrame, size: int = 5, radius: int = 2, blocks: int = 4, text: str = "text",
                            key: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (hex) and component_id: the smallest doc_id reachable over links of near fingerprints.

    Copies share a fingerprint and are compared once.  Every row is returned, repeated and null ids too; a group
    whose ids are all null has a null component.  An empty table gives an empty result.
    """
    of_docs = stored(fingerprints(docs, size, text, key), "fingerprints")
    first = stored(of_docs.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    roots = connected(hamming_edges(first, radius, blocks)).withColumnRenamed("node", "fingerprint")
    rooted = first.join(roots, "fingerprint")
    smallest = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    joined = rooted.join(smallest, "root").select("fingerprint", "component_id")
    # Stored, so that the last join has a shuffle on either side that can be split at a frequent fingerprint.
    named = stored(first.join(joined, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component_id", "first_doc").alias("component_id")), "named-fingerprints")
    return of_docs.join(named, "fingerprint").select("doc_id", hex16(F.col("fingerprint")).alias("fingerprint"), "component_id")
