"""Rows of stored files picked out where they lie: keys travel, rows do not.

A row is known by its file and its place in it.  What decides on rows is worked out from their key columns and
ends in bitmaps, one bit per row; a second scan of the files looks its rows up there and keeps the order and the
folders they are stored in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.operators.keep_first import keep_first
from kerbside.operators.settle import settle

FILE, AT = "_file", "_at"
_BLOCK, _BITS = "_block", "_bits"
BLOCK_ROWS = 1 << 15  # bits of one bitmap of bitmap_construct_agg: 4,096 bytes
# Up to so many bitmaps (128 MB, a billion rows) go to every executor; more are joined by shuffle.
BROADCAST_BLOCKS = 1 << 15


def placed(stored: DataFrame) -> DataFrame:
    """Rows of a scan, filtered or projected at most, with their file and place."""
    return stored.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(AT))


def bitmaps(places: DataFrame, *more: str) -> DataFrame:
    """(file, block, bits) of some places, kept in the shared folder; ``more`` are columns that depend on the file."""
    blocks = places.groupBy(FILE, F.expr(f"{AT} div {BLOCK_ROWS}").alias(_BLOCK), *more)
    return settle(blocks.agg(F.bitmap_construct_agg(F.col(AT) % BLOCK_ROWS).alias(_BITS)), "places")


def at_places(stored: DataFrame, bits: DataFrame, chosen: bool = True) -> DataFrame:
    """The rows of a scan whose bits are set, or with ``chosen`` false all others."""
    rows = placed(stored).withColumns({_BLOCK: F.expr(f"{AT} div {BLOCK_ROWS}")})
    bits = bits.select(FILE, _BLOCK, _BITS)
    few = bits.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS
    joined = rows.join(F.broadcast(bits) if few else bits, [FILE, _BLOCK], "inner" if chosen else "left")
    byte = F.expr(f"cast(conv(hex(substring({_BITS}, cast({AT} % {BLOCK_ROWS} div 8 as int) + 1, 1)), 16, 10) as int)")
    is_set = F.getbit(byte, (F.col(AT) % 8).cast("int")) == 1
    return joined.where(is_set if chosen else ~F.coalesce(is_set, F.lit(False))).select(*stored.columns)


def keep_first_in_place(stored: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``keep_first`` of the rows of a scan: only keys, order and places are shuffled and ranked."""
    return at_places(stored, bitmaps(keep_first(placed(stored), keys, order).select(FILE, AT)))
