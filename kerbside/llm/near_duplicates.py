"""Near duplicates by word shingles: SimHash compared bit-sliced, then exact Jaccard similarity.

At a similarity of 0.8 two SimHashes of 64 bits differ in about ten bits, too many for exact blocks of bits to
bring them together.  So documents meet in MinHash bands; within a band the bit-sliced comparison abandons what
is further apart than ``RADIUS`` bits (``SMALL_RADIUS`` for sets of few shingles, whose prints differ more), and documents it links form candidate clusters.  A cluster's shingle sets
then travel once, and every pair of a cluster that is not linked yet is compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.bit_slices import group_starts, in_blocks, linked, whole_groups
from kerbside.llm.components import connected
from kerbside.llm.scratch import stored
from kerbside.llm.simhash import shingle_hashes, simhash, words_of

BANDS, ROWS = 16, 4  # at 0.8: a pair misses all bands with probability 0.0002
RADIUS = 20  # at 0.8: about 10 bits differ with a deviation of 3
SMALL, SMALL_RADIUS = 20, 24  # sets of so few shingles: about 12 bits differ
_PIECE = 1 << 14


def _minima(hashes: np.ndarray) -> np.ndarray:
    """One hash per band: of the minima of ROWS functions over the shingles."""
    factors = np.random.default_rng(11).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), _PIECE):
        piece = hashes[start:start + _PIECE]
        for i, factor in enumerate(factors):
            x = piece * factor
            low[i] = min(low[i], (x ^ (x >> np.uint64(32))).min())
    out = np.zeros(BANDS, np.uint64)
    for row in low.reshape(BANDS, ROWS).T:
        out = (out ^ row) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, prints, bands, sizes = [], [], [], []
            for text in batch.column("text").to_pylist():
                hashes = np.unique(shingle_hashes(words_of(text or ""), size))
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                prints.append(simhash(hashes))
                bands.append(_minima(hashes).view(np.int64))
                sizes.append(len(hashes))
            signed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (nodes, prints)]
            flat = pa.array(np.concatenate(bands)) if bands else pa.array([], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(bands) + 1, dtype=np.int32) * BANDS), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), *signed, pa.array(sizes, pa.int32()), lists],
                names=["doc_id", "row_key", "node", "fingerprint", "n_shingles", "bands"])

    return run


def _shingle_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(words_of(t or ""), size)) for t in batch.column("text").to_pylist()]
            nodes = [xxhash.xxh64_intdigest(s.tobytes()) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(nodes, np.uint64).view(np.int64)), batch.column("cluster"),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "cluster", "shingles"])

    return run


def similar_stars(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set a set of its group linked by Jaccard similarity: breadth first, each against all not reached yet."""
    sizes = np.array([len(s) for s in sets])
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sets)), sizes)
    root = np.full(len(sets), -1)
    for seed in range(len(sets)):
        if root[seed] >= 0:
            continue
        root[seed], queue = seed, [seed]
        while queue:
            one = queue.pop()
            rest = root < 0
            if not rest.any():
                break
            mine = np.zeros(flat.max(initial=0) + 1, bool)
            mine[flat[starts[one]:starts[one] + sizes[one]]] = True
            common = np.bincount(owner, mine[flat] & rest[owner], len(sets))
            near = np.flatnonzero(rest & (common >= similarity * (sizes + sizes[one] - common)))
            root[near] = seed
            queue.extend(near.tolist())
    return root


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["cluster", "i", "j"]
        for table in whole_groups(batches, keys, 256):
            node = table.column("node").to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            start = group_starts([table.column(k).to_numpy() for k in keys])
            for first in np.unique(start):
                last = int(np.searchsorted(start, first, side="right"))
                root = first + similar_stars(sets[first:last], similarity)
                leaf = np.flatnonzero(root != np.arange(first, last)) + first
                yield pa.RecordBatch.from_arrays([pa.array(node[root[leaf - first]]), pa.array(node[leaf])], names=["a", "b"])

    return run


def near_duplicate_groups(docs: DataFrame, size: int = 5, similarity: float = 0.8, text: str = "text", key: str = "doc_id",
                          most: int = 2048) -> DataFrame:
    """doc_id, row_key (hash of the text) and group of every row: rows of one group are linked by similarity.

    Words are runs of other characters than ASCII white space, A-Z lower-cased; shingle sets of ``size`` words
    (fewer words: of them all) are alike from a Jaccard similarity of ``similarity`` on.  Texts without words, null
    ones too, have equal sets: one group.  ``most`` bounds what one task compares; larger clusters are met in
    pairs of blocks.
    """
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row_key"),
                      F.col(text).alias("text"))
    sketches = stored(own.mapInArrow(_sketch(size), "doc_id long, row_key long, node long, fingerprint long, n_shingles int, bands array<long>"), "sketches")
    nodes = stored(sketches.groupBy("node").agg(F.min(F.struct("doc_id", "row_key", "fingerprint", "n_shingles", "bands")).alias("of")), "nodes")
    banded = stored(nodes.select("node", "of.fingerprint", "of.n_shingles", F.posexplode("of.bands").alias("part", "bucket")), "bands")
    small = banded.where(F.col("n_shingles") <= SMALL)
    clusters = connected(linked(banded, RADIUS).unionByName(linked(small, SMALL_RADIUS)))
    members = stored(clusters.join(nodes, "node").select(
        "node", F.col("root").alias("cluster"), F.col("of.doc_id").alias("doc_id"), F.col("of.row_key").alias("row_key")), "members")
    # The texts of one row per member: few, so their ids are broadcast; else the join shuffles.
    wanted = members.select("cluster", F.col("doc_id").alias("d"), F.col("row_key").alias("r"))
    texts = own.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_key") == F.col("r"))).dropDuplicates(["doc_id", "row_key"])
    sets = texts.select("cluster", "text").mapInArrow(_shingle_sets(size), "node long, cluster long, shingles binary")
    placed = in_blocks(stored(sets, "shingle-sets"), ["cluster"], most)
    keys = ["cluster", "i", "j"]
    dealt = placed.repartition(*keys).sortWithinPartitions(*keys, "node").select(*keys, "node", "shingles")
    roots = connected(dealt.mapInArrow(_verify(similarity), "a long, b long"))
    return sketches.select("doc_id", "row_key", "node").join(roots, "node", "left").select(
        "doc_id", "row_key", F.coalesce("root", "node").alias("group"))


def deduplicated(docs: DataFrame, size: int = 5, similarity: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id (null first), then the smallest text hash."""
    groups = stored(near_duplicate_groups(docs, size, similarity, text, key), "groups")
    kept = groups.groupBy("group").agg(F.min(F.struct("doc_id", "row_key")).alias("kept"))
    rows = groups.groupBy("group", "doc_id", "row_key").agg(F.count("*").alias("times"))
    judged = stored(rows.join(kept, "group").select(
        F.col("doc_id").alias("_d"), F.col("row_key").alias("_r"), "times",
        (F.struct("doc_id", "row_key").eqNullSafe(F.col("kept"))).alias("stays")), "judged")
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).cast("long").alias("doc_id"),
                        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("row_key") == F.col("_r"))
    # Rows that go, and kept rows that stand there more than once: few, so all other texts stay where they are.
    odd = stored(judged.where(~F.col("stays") | (F.col("times") > 1)).select("_d", "_r", "stays"), "odd")
    single = whole.join(odd.select("_d", "_r"), same, "left_anti")
    repeated = whole.join(odd.where("stays").select("_d", "_r"), same, "left_semi").dropDuplicates(["doc_id", "row_key"])
    return single.unionByName(repeated).select("row.*")
