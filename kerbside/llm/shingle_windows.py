"""Word windows of texts that share a shingle with a reference, with DataFrame functions only.

Only such windows can resemble the reference at all, so looking at no others loses nothing.  Texts are known by
128 bits of hash: copies of a text are looked at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.scratch import stored

# Fixed value: a word is a run of letters and digits.
WORD = r"[\p{L}\p{N}]+"
TEXT = ["t1", "t2"]


def text_id(text: Column) -> list[Column]:
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(1), whole).alias("t2")]


def with_word_hashes(rows: DataFrame, text: str, out: str = "hashes") -> DataFrame:
    """Lower-cased words of the whole text as hashes, in order; a null text has none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD), F.lit(0))
    return rows.withColumn(out, F.transform(words, lambda w: F.xxhash64(w)))


def shingles(hashes: str, size: int) -> Column:
    """Hashes of each run of ``size`` words, repeats included; fewer words have none.

    ``hashes`` must be a column of its own (it is named several times, so it is not computed inside the loop).
    """
    last = F.size(hashes) - size
    runs = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                       lambda i: F.xxhash64(*[F.get(F.col(hashes), i + j) for j in range(size)]))
    return F.when(last >= 0, runs).otherwise(F.array().cast("array<bigint>"))


def shingle_hits(docs: DataFrame, reference: DataFrame, size: int, text: str = "text") -> DataFrame:
    """Every place of a text with a shingle of the reference (a column ``h``): t1, t2, n_words, pos and its columns."""
    own = with_word_hashes(docs.select(*text_id(F.col(text)), F.col(text).alias("_text")), "_text").drop("_text")
    places = own.select(*TEXT, F.size("hashes").alias("n_words"), F.posexplode(shingles("hashes", size)).alias("pos", "h"))
    return places.join(reference, "h")


def window_hashes(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """``windows`` (t1, t2, start, length, ..) with the hashes of their words.

    Texts with a window are few; where they are not, the join shuffles them instead of broadcasting their ids.
    """
    wanted = stored(windows.select(*TEXT).distinct(), "texts")
    own = docs.select(*text_id(F.col(text)), F.col(text).alias("_text")).join(wanted, TEXT, "left_semi")
    one_each = own.groupBy(*TEXT).agg(F.first("_text").alias("_text"))
    known = with_word_hashes(one_each, "_text", "_all")
    return known.join(windows, TEXT).select(
        *windows.columns, F.slice(F.col("_all"), F.col("start") + 1, F.col("length")).alias("hashes"))
