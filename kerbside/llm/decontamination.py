"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

A window as long as an item is looked at wherever the text shares a five-word shingle with the item, laid so that
the shared words coincide.  Windows and items get a fingerprint of their shingles.  Fingerprints that differ in
``radius`` bits or fewer agree in one of ``radius + 1`` blocks at least, so a join on the blocks brings every such
pair together; the similarity of the shingles, weighted by how often they occur, decides.  At a similarity of 0.8
about 10 bits differ, with a deviation of 3.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.scratch import stored
from kerbside.llm.shingle_windows import TEXT, shingle_hits, shingles, text_id, window_hashes, with_word_hashes


def fingerprint(hashes: str) -> Column:
    """A bit is 1 if set in over half the hashes."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def set_in(position: int) -> Column:
        return F.size(F.filter(hashes, lambda h: F.shiftrightunsigned(h, position).bitwiseAND(one) == one))

    value = none
    for b in range(64):
        value = value.bitwiseOR(F.shiftleft(F.when(set_in(b) * 2 > F.size(hashes), one).otherwise(none), b))
    return value


def blocks(value: str, n: int) -> Column:
    """The bits of a fingerprint cut into ``n`` blocks."""
    ends = [64 * i // n for i in range(n + 1)]
    return F.array(*[F.shiftrightunsigned(F.col(value), lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("long"))
                     for lo, hi in zip(ends, ends[1:], strict=False)])


def weighted_similarity(a: str, b: str) -> Column:
    """Sum of the smaller over sum of the larger weights, a shingle's weight being how often it occurs."""
    def times(where: str, s: Column) -> Column:
        return F.size(F.filter(where, lambda x: x == s))

    common = F.aggregate(F.array_distinct(F.col(b)), F.lit(0), lambda acc, s: acc + F.least(times(a, s), times(b, s)))
    return common / (F.size(a) + F.size(b) - common)


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
                 item_key: str = "item_id", size: int = 5, similarity: float = 0.8, radius: int = 24) -> DataFrame:
    """doc_id, item_id, window_start (words), hamming and similarity: each item found in each document, at its most
    similar window (the first of equals).

    Words are lower-cased runs of letters and digits.  Items of fewer than ``size`` words have no shingle and are
    found nowhere; null texts have no words; repeated rows each have their rows, and copies of an item each theirs.
    """
    known = with_word_hashes(items.select(F.col(item_key).alias("item_id"), F.col(item_text).alias("_text")), "_text").drop("_text")
    named = known.where(F.size("hashes") >= size).select(
        "item_id", F.xxhash64("hashes").alias("item"), F.size("hashes").alias("length"), "hashes", shingles("hashes", size).alias("item_shingles"))
    named = stored(named, "items")
    distinct = named.drop("item_id").dropDuplicates(["item"])
    reference = stored(distinct.select("item", "length", F.posexplode("item_shingles").alias("item_pos", "h")), "item-shingles")
    prints = stored(distinct.select("item", "item_shingles", fingerprint("item_shingles").alias("item_print")), "item-prints")

    hits = shingle_hits(docs, reference, size, text)
    start = F.greatest(F.lit(0), F.least(F.col("pos") - F.col("item_pos"), F.col("n_words") - F.col("length")))
    windows = stored(hits.select(*TEXT, "item", "length", start.alias("start")).distinct(), "windows")
    own = window_hashes(docs, windows, text).select(*TEXT, "item", "start", shingles("hashes", size).alias("shingles"))
    looked_at = stored(stored(own, "window-shingles").withColumn("print", fingerprint("shingles")), "window-prints")

    n = radius + 1
    asked = looked_at.select("*", F.posexplode(blocks("print", n)).alias("block", "value"))
    offered = prints.select("*", F.posexplode(blocks("item_print", n)).alias("block", "value"))
    met = asked.join(offered, ["item", "block", "value"])
    first_block = F.array_position(F.zip_with(blocks("print", n), blocks("item_print", n), lambda x, y: x == y), True) - 1
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = met.where((F.col("block") == first_block) & (distance <= radius)).select(
        *TEXT, "item", "start", distance.alias("hamming"), weighted_similarity("shingles", "item_shingles").alias("similarity"))
    best = near.where(F.col("similarity") >= similarity).groupBy(*TEXT, "item").agg(
        F.min(F.struct((-F.col("similarity")).alias("unlike"), "start", "hamming")).alias("best"))
    found = stored(best.join(named.select("item", "item_id"), "item").select(
        *TEXT, "item_id", F.col("best.start").alias("window_start"), F.col("best.hamming").cast("int").alias("hamming"),
        (-F.col("best.unlike")).alias("similarity")), "contaminated")
    return docs.select(F.col(key).alias("doc_id"), *text_id(F.col(text))).join(found, TEXT).drop(*TEXT)


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found."""
    own = docs.select(F.col(text).alias("doc_id"), F.col(text).alias("text"))
    dirty = stored(contaminated(own, items, **options).select(*text_id(F.col("doc_id"))).distinct(), "dirty")
    whole = docs.select(F.struct(*docs.columns).alias("row"), *text_id(F.col(text)))
    return whole.join(dirty, TEXT, "left_anti").select("row.*")
