"""Line de-duplication that returns keep bitmaps instead of texts.

Lines become (key hash, document, position) rows.  The rows are range-partitioned by (hash, document) and
sorted by hash, document descending and position, so one pass over a partition sees a key's documents
together, the largest first.  A key may go on in the next partition, so the first and last run of each chunk
of rows stay undecided: they leave a summary each, and the summaries, added up per key, decide them.  A key
that fills many partitions is never gathered in one task.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.scratch import stored

# The ASCII white space that is stripped, and the letters that are lower-cased.
WHITE_SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DROP, EDGE, SUMMARY = 0, 1, 2
_RUNS = "kind int, h1 long, h2 long, doc_id long, row_key long, pos int, n_docs long"
_DIGEST = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("kept_sha256", T.StringType())])
NO_ID = -2**63  # stands for a null doc_id: smaller than any other


def line_key(line: Column) -> Column:
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    stripped = F.regexp_replace(line, rf"^{WHITE_SPACE}+|{WHITE_SPACE}+\z", "")
    return F.translate(stripped, UPPER, LOWER)


def _row_key(text: Column) -> Column:
    """Tells rows apart that share a doc_id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _stream(min_docs: int, chunk_rows: int):
    """Decide every key run that lies inside a chunk of sorted rows; leave its first and last run to the summaries."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # key and document of the row before the chunk
        for rows in _chunks(batches, chunk_rows):
            h1, h2, doc = (rows[c].to_numpy() for c in ("h1", "h2", "doc_id"))
            opens = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            starts = np.flatnonzero(opens)
            sizes = np.diff(np.r_[starts, len(h1)])
            n_docs = np.add.reduceat((np.r_[True, doc[1:] != doc[:-1]] | opens).astype(np.int64), starts)
            if before == (h1[0], h2[0], doc[0]):
                n_docs[0] -= 1  # counted with the chunk before
            before = h1[-1], h2[-1], doc[-1]
            run = np.repeat(np.arange(len(starts)), sizes)
            edge = (run == 0) | (run == len(starts) - 1)
            drop = ~edge & (n_docs >= min_docs)[run] & (doc != doc[starts][run])
            ends = np.unique([0, len(starts) - 1])
            yield _marked(rows.filter(pa.array(drop)), DROP)
            yield _marked(rows.filter(pa.array(edge)), EDGE)
            yield _marked(rows.take(pa.array(starts[ends])), SUMMARY, n_docs[ends])

    return runs


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= size:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _marked(rows: pa.Table, kind: int, n_docs: np.ndarray | None = None) -> pa.RecordBatch:
    counts = np.zeros(rows.num_rows, np.int64) if n_docs is None else n_docs
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(rows.num_rows, kind, np.int32)), *[c.combine_chunks() for c in rows.columns], pa.array(counts)],
        names=["kind", *rows.column_names, "n_docs"])


def dropped_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_docs: int = 3,
                  min_chars: int = 20, chunk_rows: int = 262_144) -> DataFrame:
    """(doc_id, row_key, pos) of every line to drop; positions count from 0.

    A line goes if its key has ``min_chars`` code points or more, is held by ``min_docs`` distinct documents or
    more, and this is not the largest of them.  Rows with a null id hold one document of the smallest id.
    """
    session = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc_id"), _row_key(F.col(text)).alias("row_key"),
                        F.posexplode(F.split(whole, "\n", -1)).alias("pos", "line"))
    keyed = lines.withColumn("line", line_key(F.col("line"))).where(F.char_length("line") >= min_chars)
    hashed = keyed.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), F.col("line")).alias("h2"),
                          "doc_id", "row_key", "pos")
    rows = stored(hashed, "lines")  # ranges are cut from a sample: without this the texts would be read twice
    width = max(int(session.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    ranged = rows.repartitionByRange(width, "h1", "h2", F.desc("doc_id")).sortWithinPartitions(
        "h1", "h2", F.desc("doc_id"), "row_key", "pos")
    runs = stored(ranged.mapInArrow(_stream(min_docs, chunk_rows), _RUNS), "line-runs")
    # Stored, so that the planner knows how few totals there are and need not shuffle a frequent key's rows.
    totals = stored(runs.where(F.col("kind") == SUMMARY).groupBy("h1", "h2").agg(
        F.sum("n_docs").alias("docs"), F.max("doc_id").alias("largest")).where(F.col("docs") >= min_docs), "line-totals")
    edges = runs.where(F.col("kind") == EDGE).join(totals, ["h1", "h2"]).where(F.col("doc_id") != F.col("largest"))
    columns = ["doc_id", "row_key", "pos"]
    return runs.where(F.col("kind") == DROP).select(columns).unionByName(edges.select(columns))


@F.pandas_udf(T.BinaryType())
def _packed(positions: pd.Series, n_lines: pd.Series) -> pd.Series:
    """Keep bitmap: bit i, least significant first in its byte, is 1 if line i stays; deflated."""

    def pack(gone, n: int) -> bytes:
        bits = np.ones(-(-n // 8) * 8, np.uint8)  # whole bytes: the bits after the last line keep
        bits[np.asarray(gone, np.int64)] = 0
        return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)

    return pd.Series([pack(p, n) for p, n in zip(positions, n_lines, strict=True)], dtype=object)


def keep_bitmaps(docs: DataFrame, text: str = "text", key: str = "doc_id", min_docs: int = 3,
                 min_chars: int = 20) -> DataFrame:
    """(doc_id, row_key, n_dropped, keep): the documents that lose lines, with a deflated bitmap of the lines kept.

    A bitmap ends at the last dropped line: lines beyond it, and documents not listed, are kept.  ``row_key`` is the hash
    of the text, so rows that share a doc_id have bitmaps of their own.
    """
    gone = dropped_lines(docs, text, key, min_docs, min_chars).distinct().groupBy("doc_id", "row_key").agg(
        F.collect_list("pos").alias("gone"), F.max("pos").alias("last"))
    return gone.select("doc_id", "row_key", F.size("gone").alias("n_dropped"),
                       _packed(F.col("gone"), F.col("last") + 1).alias("keep"))


def _kept(text: str, keep: bytes | None) -> str:
    if keep is None:
        return text
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    lines = text.split("\n")
    return "\n".join(line for i, line in enumerate(lines) if i >= len(bits) or bits[i])


@F.pandas_udf(T.StringType())
def kept_text(text: pd.Series, keep: pd.Series) -> pd.Series:
    """The text without the lines whose bit is 0; a null bitmap keeps all."""
    return pd.Series([_kept(t, k) for t, k in zip(text, keep, strict=True)], dtype=object)


@F.pandas_udf(_DIGEST)
def kept_digest(text: pd.Series, keep: pd.Series) -> pd.DataFrame:
    """Lines before dropping, and SHA-256 of what is kept."""
    kept = [_kept(t, k) for t, k in zip(text, keep, strict=True)]
    return pd.DataFrame({"n_lines": [t.count("\n") + 1 for t in text],
                         "kept_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in kept]})


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, keep, n_dropped) for every row of ``docs``: its columns as a struct, and null where all lines stay."""
    marks = bitmaps.select(F.col("doc_id").alias("d"), F.col("row_key").alias("r"), "keep", "n_dropped")
    own = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("d"),
                      _row_key(F.col(text)).alias("r"))
    return own.join(marks, ["d", "r"], "left").drop("d", "r")


def deduplicated(docs: DataFrame, text: str = "text", key: str = "doc_id", min_docs: int = 3,
                 min_chars: int = 20) -> DataFrame:
    """``docs`` with the repeated lines taken out of their texts; a null text stays null."""
    marked = with_bitmaps(docs, keep_bitmaps(docs, text, key, min_docs, min_chars), text, key)
    old = F.col("row")[text]
    thinned = F.when(F.col("keep").isNotNull(), kept_text(old, F.col("keep"))).otherwise(old)
    return marked.select(*[(thinned if c == text else F.col("row")[c]).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the kept lines, a row per document (null text: one empty line)."""
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    marked = with_bitmaps(own, keep_bitmaps(own))
    digest = kept_digest(F.coalesce("row.text", F.lit("")), F.col("keep"))
    return marked.select("row.doc_id", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                         digest.alias("d")).select("doc_id", "d.n_lines", "n_dropped", "d.kept_sha256")
