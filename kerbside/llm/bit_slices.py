"""Bit-sliced Hamming comparison of 64-bit fingerprints within buckets.

64 fingerprints stand side by side in a word of each bit plane.  Against one fingerprint, a word of a plane gives
64 differing bits at once; carry-save adders count them in vertical counters that overflow beyond the radius.
A word all of whose counters have overflowed is abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.scratch import stored

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_SLICE = 1 << 18  # (fingerprint, word) comparisons at a time
_CHUNK = 1 << 15  # rows of whole buckets at a time


def planes_of(fingerprints: np.ndarray) -> np.ndarray:
    """(64, words): bit b of fingerprint i is bit i % 64 of word i // 64 of plane b."""
    padded = np.zeros(-(-len(fingerprints) // 64) * 64, np.uint64)
    padded[:len(fingerprints)] = fingerprints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def _add(counters: list[np.ndarray], level: int, carry: np.ndarray, over: np.ndarray) -> None:
    for counter in counters[level:]:
        carry, counter[:] = counter & carry, counter ^ carry
    over |= carry


def within_radius(query: np.ndarray, word: np.ndarray, over: np.ndarray, planes: np.ndarray, radius: int,
                  bits: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of a query fingerprint and a word: the pairs left, and a mask of the columns within the radius.

    ``over`` marks the columns not asked for; ``bits`` are the positions that may differ.
    """
    width = max(1, radius.bit_length())
    preset = (1 << width) - 1 - radius  # counting from here, the radius is the largest value that fits
    counters = [np.full(len(query), ALL if preset >> i & 1 else 0, np.uint64) for i in range(width)]
    pair = np.arange(len(query))
    for start in range(0, len(bits), 3):
        differ = [planes[b][word] ^ np.where((query >> np.uint64(b)) & np.uint64(1), ALL, np.uint64(0))
                  for b in bits[start:start + 3]]
        if len(differ) == 3:
            x, y, z = differ
            half = x ^ y
            _add(counters, 0, half ^ z, over)
            _add(counters, 1, (x & y) | (half & z), over)
        else:
            for one in differ:
                _add(counters, 0, one, over)
        alive = over != ALL
        if start % 6 == 3 and alive.mean() < 0.7:
            query, word, over, pair = query[alive], word[alive], over[alive], pair[alive]
            counters = [c[alive] for c in counters]
            if not len(pair):
                break
    alive = over != ALL
    return pair[alive], ~over[alive]


class _Forest:
    """Minimum-label union-find over the rows of a chunk."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.up[a], self.up[b]
            open_pairs = a != b
            a, b = a[open_pairs], b[open_pairs]
            np.minimum.at(self.up, np.maximum(a, b), np.minimum(a, b))
            self.flatten()

    def flatten(self) -> None:
        while (self.up != (further := self.up[self.up])).any():
            self.up = further


def forest_of_buckets(fingerprint: np.ndarray, bucket_start: np.ndarray, radius: int, bits: list[int]) -> np.ndarray:
    """For rows ordered by bucket (given each row's bucket start): the first row of its linked group in the bucket."""
    n = len(fingerprint)
    planes = planes_of(fingerprint)
    last = np.r_[np.flatnonzero(np.diff(bucket_start)), n - 1]
    end = last[np.searchsorted(last, np.arange(n))]  # last row of the bucket
    forest = _Forest(n)
    rows = np.flatnonzero(end > np.arange(n))
    spans = end[rows] // 64 - rows // 64 + 1
    before = np.cumsum(spans) - spans
    cuts = np.searchsorted(before, np.arange(0, spans.sum(), _SLICE)) if len(rows) else np.array([], np.int64)
    for lo, hi in zip(cuts, [*cuts[1:], len(rows)], strict=True):
        span = spans[lo:hi]
        row = np.repeat(rows[lo:hi], span)
        word = row // 64 + np.arange(len(row)) - np.repeat(np.cumsum(span) - span, span)
        # Columns of other buckets and columns up to the row itself are not asked for.
        low = np.clip(row + 1 - word * 64, 0, 64).astype(np.uint64)
        high = np.clip(end[row] + 1 - word * 64, 0, 64).astype(np.uint64)
        over = ~(_ones(high) & ~_ones(low))
        pair, mask = within_radius(fingerprint[row], word, over, planes, radius, bits)
        if len(pair):
            which, column = np.nonzero(np.unpackbits(mask.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            forest.link(row[pair][which], word[pair][which] * 64 + column)
    forest.flatten()
    return forest.up


def _ones(n: np.ndarray) -> np.ndarray:
    """n low bits set, n up to 64."""
    return np.where(n >= 64, ALL, (np.uint64(1) << np.minimum(n, np.uint64(63))) - np.uint64(1))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], size: int) -> Iterator[pa.Table]:
    """Sorted rows in chunks of about ``size`` that end where a group ends."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < size:
            continue
        table = pa.Table.from_batches(held)
        columns = [table.column(k).to_numpy() for k in keys]
        changes = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))
        if len(changes):
            cut = changes[-1] + 1
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            rows = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def group_starts(columns: list[np.ndarray]) -> np.ndarray:
    """For each row of sorted key columns, the first row of its group."""
    opens = np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns])]
    starts = np.flatnonzero(opens)
    return np.repeat(starts, np.diff(np.r_[starts, len(opens)]))


def _link(radius: int, bits_of: dict[int, list[int]]):
    every = list(range(64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["part", "bucket", "i", "j"], _CHUNK):
            keys = [table.column(k).to_numpy() for k in ("part", "bucket", "i", "j")]
            start = group_starts(keys)
            shared = np.bincount(start, minlength=len(start))[start] > 1
            node, fingerprint = table.column("node").to_numpy(), table.column("fingerprint").to_numpy().view(np.uint64)
            for part in np.unique(keys[0][shared]):
                rows = np.flatnonzero(shared & (keys[0] == part))
                up = forest_of_buckets(fingerprint[rows], start[rows], radius, bits_of.get(int(part), every))
                leaf = np.flatnonzero(up != np.arange(len(up)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[rows[up[leaf]]]), pa.array(node[rows[leaf]])], names=["a", "b"])

    return run


def in_blocks(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """``rows`` with block columns i <= j, such that any two rows of a group meet in a group of (keys, i, j).

    Groups of up to ``most`` rows get (0, 0).  A larger group is cut into blocks by a hash, and a row goes to each
    pair of blocks that its own is in: all pairs are met, none in a task that holds more than two blocks.
    """
    sizes = rows.groupBy(*keys).count().where(F.col("count") > most)
    blocks = sizes.select(*keys, F.ceil(F.col("count") / F.lit(most // 2)).cast("int").alias("blocks"))
    placed = rows.join(blocks, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int")
    spread = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("own", "other", "blocks")


def linked(rows: DataFrame, radius: int, bits_of: dict[int, list[int]] | None = None, most: int = 1 << 14) -> DataFrame:
    """Edges (a, b) that join, within each bucket, all nodes whose fingerprints differ in ``radius`` bits or fewer.

    ``rows``: part int, bucket long, node long, fingerprint long.  Of a group of linked nodes in a bucket only a
    spanning star is returned, so the edges never outnumber the rows.
    """
    placed = in_blocks(rows, ["part", "bucket"], most)
    keys = ["part", "bucket", "i", "j"]
    dealt = placed.repartition(*keys).sortWithinPartitions(*keys, "node")
    return dealt.select(*keys, "node", "fingerprint").mapInArrow(_link(radius, bits_of or {}), "a long, b long")


def hamming_edges(fingerprints: DataFrame, radius: int = 2, blocks: int = 4, column: str = "fingerprint") -> DataFrame:
    """Edges between distinct fingerprints within the radius.

    With ``radius`` differing bits at most, all but ``radius`` of the ``blocks`` agree: every choice of blocks that
    may agree is a table of buckets, so no pair is lost.
    """
    ends = [64 * i // blocks for i in range(blocks + 1)]
    tables, bits_of = [], {}
    for part, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << (ends[b + 1] - ends[b])) - 1) << ends[b] for b in kept)
        bits_of[part] = [b for b in range(64) if not mask >> b & 1]
        tables.append(F.struct(F.lit(part).alias("part"), F.col(column).bitwiseAND(F.lit(_signed(mask))).alias("bucket")))
    distinct = fingerprints.select(F.col(column)).distinct()
    rows = distinct.select(F.col(column).alias("node"), F.col(column).alias("fingerprint"), F.explode(F.array(*tables)).alias("t"))
    return linked(stored(rows.select("t.*", "node", "fingerprint"), "buckets"), radius, bits_of)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def hex16(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
