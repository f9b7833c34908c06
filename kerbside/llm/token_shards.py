"""Token ids in binary shards, with keyed access through a minimal perfect hash index.

A shard file holds the ids of consecutive documents as little-endian integers from its first byte on, and ends
in a trailer (documents, ids, bytes per id, magic).  Keys are hashed into buckets of bounded size; each bucket's
minimal perfect hash gives a key its slot in arrays of fingerprint, shard, offset and length: constant-time
lookup, a few bits of hash per key, and no index built in one place.

A task names its file anew on each attempt and reports it in its rows; only rows of committed attempts are
stored, so a file that a lost attempt left behind is never read.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm.chunked_encoder import worker_encoder

MAGIC = 0x4B544F4B
TRAILER = "<QQII"
_ROWS = "shard int, file string, width int, doc_id long, offset long, n_ids long"
_HIT = "doc_id long, shard int, offset long, n_ids long"
_BATCH = 256
GAMMA = 2.0  # bits per key of a level: fewer make the index smaller and a lookup longer


# ---- minimal perfect hash ----

def _positions(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = h1 + np.uint64(level) * (h2 | np.uint64(1))
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(11)) % np.uint64(size)


def _fingerprint(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return ((h1 ^ (h2 >> np.uint64(7))) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0..n-1 for n distinct 128-bit hashes: at each level the keys alone at their bit keep it, others go on."""

    def __init__(self, sizes: list[int], words: list[np.ndarray]):
        self.sizes, self.words = sizes, words
        counts = [np.bitwise_count(w).astype(np.int64) for w in words]
        ends = np.cumsum([c.sum() for c in counts])
        self.ranks = [np.cumsum(c) - c + (ends[i] - c.sum()) for i, c in enumerate(counts)]

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, max_levels: int = 200) -> PerfectHash:
        sizes, words = [], []
        while len(h1):
            if len(sizes) == max_levels:
                raise ValueError("two keys have the same 128-bit hash")
            size = -(-max(int(GAMMA * len(h1)), 1) // 64) * 64
            at = _positions(h1, h2, len(sizes), size).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8").copy())
            sizes.append(size)
            rest = ~alone[at]
            h1, h2 = h1[rest], h2[rest]
        return cls(sizes, words)

    def slots(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """-1 where no level has the key's bit: surely not a key of the index."""
        found = np.full(len(h1), -1, np.int64)
        open_rows = np.arange(len(h1))
        for level, (size, words, ranks) in enumerate(zip(self.sizes, self.words, self.ranks, strict=True)):
            at = _positions(h1[open_rows], h2[open_rows], level, size)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[open_rows[hit]] = (ranks[word] + np.bitwise_count(below))[hit]
            open_rows = open_rows[~hit]
        return found


def _index_bytes(rows: pd.DataFrame) -> bytes:
    h1, h2 = (rows[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    table = PerfectHash.build(h1, h2)
    order = np.empty(len(rows), np.int64)
    order[table.slots(h1, h2)] = np.arange(len(rows))
    out = io.BytesIO()
    np.savez(out, sizes=np.array(table.sizes, np.int64), words=np.concatenate(table.words),
             fingerprint=_fingerprint(h1, h2)[order], **{c: rows[c].to_numpy()[order] for c in ("shard", "offset", "n_ids")})
    return out.getvalue()


def _lookup(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    empty = pd.DataFrame({"doc_id": [], "shard": [], "offset": [], "n_ids": []}).astype("int64")
    if keys.empty or index.empty:
        return empty
    saved = np.load(io.BytesIO(index["entry"].iloc[0]))
    sizes = saved["sizes"].tolist()
    words = np.split(saved["words"], np.cumsum([s // 64 for s in sizes])[:-1])
    h1, h2 = (keys[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
    slot = PerfectHash(sizes, words).slots(h1, h2)
    known = (slot >= 0) & (saved["fingerprint"][slot] == _fingerprint(h1, h2))
    slot = slot[known]
    return pd.DataFrame({"doc_id": keys["doc_id"].to_numpy()[known], **{c: saved[c][slot] for c in ("shard", "offset", "n_ids")}})


# ---- writing ----

def _file(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _write_shard(folder: str, tokenizer, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        name = f"{shard:06d}-{uuid4().hex}.ids"
        encoder, offset, n_docs, sink = worker_encoder(tokenizer.value), 0, 0, None
        end = b"" if end_id is None else end_id.to_bytes(encoder.width, "little")
        for batch in batches:
            for start in range(0, batch.num_rows, _BATCH):
                part = batch.slice(start, _BATCH)
                if sink is None:
                    system, path = _file(f"{folder}/{name}")
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    sink = system.open_output_stream(path)
                ids = [i + end for i in encoder.payloads([t or "" for t in part.column("text").to_pylist()])]
                sink.write(b"".join(ids))
                sizes = np.array([len(i) // encoder.width for i in ids], np.int64)
                starts = offset + np.cumsum(sizes) - sizes
                offset, n_docs = offset + int(sizes.sum()), n_docs + len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(ids), pa.int32()), pa.array([name] * len(ids)),
                     pa.array([encoder.width] * len(ids), pa.int32()), part.column("doc_id"), pa.array(starts), pa.array(sizes)],
                    names=["shard", "file", "width", "doc_id", "offset", "n_ids"])
        if sink is not None:
            sink.write(struct.pack(TRAILER, n_docs, offset, encoder.width, MAGIC))
            sink.close()

    return run


def _hashes() -> list:
    return [F.xxhash64("doc_id").alias("h1"), F.xxhash64(F.lit(1), F.col("doc_id")).alias("h2")]


def _build_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []

    def entry(parts: list[pd.DataFrame]) -> pd.DataFrame:
        rows = pd.concat(parts)
        return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "entry": [_index_bytes(rows)]})

    for batch in batches:
        for bucket, rows in batch.groupby("bucket", sort=True):
            if held and held[0]["bucket"].iloc[0] != bucket:
                yield entry(held)
                held = []
            held.append(rows)
    if held:
        yield entry(held)


@dataclass(frozen=True)
class TokenShards:
    """A written folder: ``ids/`` the shard files, ``rows`` a row per document, ``index`` the hash buckets."""

    spark: SparkSession
    root: str
    n_buckets: int

    @property
    def _rows(self) -> DataFrame:
        return self.spark.read.schema(_ROWS).parquet(f"{self.root}/rows")

    def shards(self) -> DataFrame:
        """One row per shard file, with the number of ids in the shards before it."""
        sizes = self._rows.groupBy("shard", "file", "width").agg(F.sum("n_ids").alias("ids"))
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard, not per document
        return sizes.withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0)))

    def locate(self, keys: DataFrame, key: str = "doc_id") -> DataFrame:
        """doc_id, shard, offset, n_ids of the distinct keys that the index has."""
        own = keys.select(F.col(key).cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull()).distinct()
        own = own.select("doc_id", *_hashes()).withColumn("bucket", F.pmod("h1", F.lit(self.n_buckets)))
        index = self.spark.read.schema("bucket long, entry binary").parquet(f"{self.root}/index")
        return own.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(_lookup, _HIT)

    def read(self, keys: DataFrame, key: str = "doc_id") -> DataFrame:
        """doc_id, start (ids of all documents before it), n_ids and the ids as little-endian 32-bit integers."""
        found = self.locate(keys, key).join(self.shards(), "shard")
        near = found.repartition("shard").sortWithinPartitions("shard", "offset")
        return near.mapInPandas(_payloads(f"{self.root}/ids"), "doc_id long, start long, n_ids long, ids binary")


def _payloads(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, source, size = None, None, struct.calcsize(TRAILER)
        for batch in batches:
            for start in range(0, len(batch), _BATCH):
                rows = batch.iloc[start:start + _BATCH]
                ids = []
                for file, width, offset, n in zip(rows["file"], rows["width"], rows["offset"], rows["n_ids"], strict=True):
                    if file != name:
                        if source is not None:
                            source.close()
                        system, path = _file(f"{folder}/{file}")
                        name, source = file, system.open_input_file(path)
                        magic = struct.unpack(TRAILER, source.read_at(size, source.size() - size))[-1]
                        if magic != MAGIC:
                            raise ValueError(f"{file} is no shard of token ids")
                    raw = np.frombuffer(source.read_at(n * width, offset * width), f"<u{width}")
                    ids.append(raw.astype("<u4").tobytes())
                yield pd.DataFrame({"doc_id": rows["doc_id"].to_numpy(), "start": (rows["first_id"] + rows["offset"]).to_numpy(),
                                    "n_ids": rows["n_ids"].to_numpy(), "ids": ids})
        if source is not None:
            source.close()

    return run


def write_token_shards(docs: DataFrame, root: str, tokenizer_file: str, end_id: int | None = None, text: str = "text",
                       key: str = "doc_id", shard_bytes: int = 16 << 20, bucket_keys: int = 32_768) -> TokenShards:
    """Encode every row in ascending key order into shards of about ``shard_bytes`` of text, and index them.

    Null texts are empty.  Rows with the same key follow each other in the order of their text hash, and the index
    leads to the first of them; rows with a null key come first and have no entry.  An empty table gives an
    empty folder that answers every key with nothing.
    """
    session = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as source:
        model = session.sparkContext.broadcast(source.read())
    whole = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n_bytes, = whole.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    ranged = whole.repartitionByRange(max(1, -(-n_bytes // shard_bytes)), *order).sortWithinPartitions(*order)
    ranged.mapInArrow(_write_shard(f"{root}/ids", model, end_id), _ROWS).write.parquet(f"{root}/rows")

    rows = session.read.schema(_ROWS).parquet(f"{root}/rows").where(F.col("doc_id").isNotNull())
    firsts = rows.groupBy("doc_id").agg(F.min(F.struct("shard", "offset", "n_ids")).alias("at"))
    n_buckets = max(1, -(-rows.count() // bucket_keys))
    entries = firsts.select("doc_id", "at.*", *_hashes()).withColumn("bucket", F.pmod("h1", F.lit(n_buckets)))
    entries.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(
        _build_buckets, "bucket long, entry binary").write.parquet(f"{root}/index")
    return TokenShards(session, root, n_buckets)


@F.pandas_udf(T.LongType())
def ids_crc32(ids: pd.Series) -> pd.Series:
    return ids.map(zlib.crc32).astype("int64")
