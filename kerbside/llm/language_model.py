"""Log-probabilities of texts under a bigram model whose counts live in a log-frequency Bloom filter.

Counting: tasks add up word and bigram hashes before anything is shuffled; the sums are dealt to segments by hash.
Each segment becomes a Bloom filter of its own that holds n-gram x with quantised count q as the q events (x, 1) ..
(x, q); it is sized by its events, so false counts do not grow with the corpus.  Beside it stand the exact word
counts for the base score.

Scoring: a worker loads the segments in shards of bounded size and asks (x, 1), (x, 2), .. until one is absent:
the number of hits gives the count.  The filter grows with the corpus, so it goes to the workers through the shared
folder and not through the driver, and a worker holds one shard at a time, however many there are.  A task gathers its
texts' n-grams first, in the order of their segments and beyond a bound in a file of its own, and then goes through the
shards once: of the model it reads every file once, however many texts it has.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.scratch import scratch_path
from kerbside.llm.simhash import SEED, words_of

# Marks no word can equal: words hold no blank.
END = np.uint64(xxhash.xxh64_intdigest(b" end", SEED))
START = np.uint64(xxhash.xxh64_intdigest(b" start", SEED))

BITS_PER_EVENT = 16
PROBE_BITS = 4  # bits of one event, all within one 64-bit word of the filter; each event of an n-gram has its own word
_CHUNK_TOKENS = 1 << 20
_PROBED_AT_ONCE = 1 << 17
_GROUP_TOKENS = 1 << 26  # of the texts that are scored in one pass over the model
_HELD_BYTES = 96 << 20  # of these tokens' n-grams in memory, about six million tokens; more go to a temporary file
_COUNTS = "segment int, key long, n long, is_word boolean"
_SEGMENTS = "segment int, filter binary, words binary, counts binary, tokens long, n_words long, filter_words long"
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


# ---- hashing ----

def _mix(keys: np.ndarray, salt: int) -> np.ndarray:
    x = keys + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bigrams(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _mix(before, 1) * np.uint64(0xD6E8FEB86659FD93) + word


def _segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return ((_mix(keys, 2) >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _event(keys: np.ndarray, level: int, n_words: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The word of each event (key, level) in a filter of ``n_words``, and its bits there."""
    bits = _mix(keys, 3 + level)
    word = (bits >> np.uint64(32)) * np.asarray(n_words, np.uint64) >> np.uint64(32)
    mask = np.zeros(len(keys), np.uint64)
    for i in range(PROBE_BITS):
        mask |= np.uint64(1) << ((bits >> np.uint64(6 * i)) & np.uint64(63))
    return word.astype(np.int64), mask


def token_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, an end after each text; and each text's number of tokens."""
    words = [words_of(t) for t in texts]
    sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    hashes = np.full(int(sizes.sum()), END, np.uint64)
    inner = np.ones(len(hashes), bool)
    inner[np.cumsum(sizes) - 1] = False
    hashes[inner] = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words), repeat(SEED)), np.uint64, len(hashes) - len(words))
    return hashes, sizes


def bigram_hashes(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return _bigrams(_before(tokens, sizes, START), tokens)


def _before(values: np.ndarray, sizes: np.ndarray, first) -> np.ndarray:
    """Each token's predecessor's value; a text's first token gets ``first``."""
    shifted = np.empty_like(values)
    shifted[1:] = values[:-1]
    shifted[np.cumsum(sizes) - sizes] = first
    return shifted


def _text_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Batches with their tokens, gathered up to a bounded number of tokens."""
    held, tokens, sizes, total = [], [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            hashes, lengths = token_hashes([t or "" for t in part.column("text").to_pylist()])
            held.append(part)
            tokens.append(hashes)
            sizes.append(lengths)
            total += len(hashes)
            if total >= _CHUNK_TOKENS:
                yield pa.Table.from_batches(held), np.concatenate(tokens), np.concatenate(sizes)
                held, tokens, sizes, total = [], [], [], 0
    if held:
        yield pa.Table.from_batches(held), np.concatenate(tokens), np.concatenate(sizes)


# ---- counting ----

def _count(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tokens, sizes in _text_chunks(batches):
            for keys, is_word in ((tokens, True), (bigram_hashes(tokens, sizes), False)):
                distinct, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_segment_of(distinct, segments).astype(np.int32)), pa.array(distinct.view(np.int64)),
                     pa.array(n.astype(np.int64)), pa.array(np.full(len(n), is_word))],
                    names=["segment", "key", "n", "is_word"])

    return run


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.add.reduceat(n, starts) if len(starts) else n


def quantised(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count)."""
    return np.frexp(counts.astype(np.float64))[1]


def build_filter(keys: np.ndarray, counts: np.ndarray, bits_per_event: int = BITS_PER_EVENT) -> np.ndarray:
    levels = quantised(counts)
    words = np.zeros(max(1, -(-int(levels.sum()) * bits_per_event // 64)), np.uint64)
    level = 1
    while len(keys):
        np.bitwise_or.at(words, *_event(keys, level, len(words)))
        level += 1
        keys, levels = keys[levels >= level], levels[levels >= level]
    return words


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A partition has the few segments that its hash gave it; their rows are kept apart as they come.
    held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        segment, key, n = (batch.column(c).to_numpy() for c in ("segment", "key", "n"))
        is_word = batch.column("is_word").to_numpy(zero_copy_only=False)
        for s in np.unique(segment):
            here = segment == s
            held.setdefault(int(s), []).append((key[here].view(np.uint64), n[here], is_word[here]))
    for s in list(held):
        key, n, is_word = (np.concatenate(x) for x in zip(*held.pop(s), strict=True))
        words, counts = _summed(key[is_word], n[is_word])
        pairs, pair_counts = _summed(key[~is_word], n[~is_word])
        bloom = build_filter(np.r_[words, pairs], np.r_[counts, pair_counts])
        yield pa.RecordBatch.from_pylist([{
            "segment": s, "filter": bloom.tobytes(), "words": words.tobytes(), "counts": counts.tobytes(),
            "tokens": int(counts.sum()), "n_words": len(words), "filter_words": len(bloom)}], schema=_SEGMENT_TYPE)


_SEGMENT_TYPE = pa.schema([("segment", pa.int32()), ("filter", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()),
                           ("tokens", pa.int64()), ("n_words", pa.int64()), ("filter_words", pa.int64())])


@dataclass(frozen=True)
class BigramModel:
    """A counted corpus: its segments in the shared folder, and how many make a shard."""

    path: str
    segments: int
    shards: tuple[tuple[int, int], ...]  # first and last segment
    sizes: tuple[tuple[int, int], ...]  # of each segment: words of its filter, and distinct words
    files: tuple[str | None, ...]  # of each segment: the file that has it
    tokens: int
    vocabulary: int


def train(docs: DataFrame, text: str = "text", segment_bytes: int = 4 << 20, shard_bytes: int = 16 << 20) -> BigramModel:
    """Count every word and bigram of all texts (null: empty).  One segment per ``segment_bytes`` of text; a shard
    is as many segments as stay below ``shard_bytes``, the bound of what a worker holds of the model."""
    session = docs.sparkSession
    whole = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    n_bytes, = whole.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    segments = max(1, -(-n_bytes // segment_bytes))
    path = scratch_path(session, "bigrams")
    counts = whole.mapInArrow(_count(segments), _COUNTS)
    counts.repartition(segments, "segment").mapInArrow(_build, _SEGMENTS).write.parquet(path)
    rows = session.read.schema(_SEGMENTS).parquet(path).select(
        "segment", "tokens", "n_words", "filter_words", F.col("_metadata.file_name").alias("file")).collect()  # no payload
    of = {r["segment"]: r for r in rows}
    sizes = tuple((of[s]["filter_words"], of[s]["n_words"]) if s in of else (1, 0) for s in range(segments))
    files = tuple(of[s]["file"] if s in of else None for s in range(segments))
    shards, first, held = [], 0, 0
    for segment, (filter_words, n_words) in enumerate(sizes):
        size = 8 * filter_words + 16 * n_words
        if held and held + size > shard_bytes:
            shards.append((first, segment - 1))
            first, held = segment, 0
        held += size
    shards.append((first, segments - 1))
    return BigramModel(path, segments, tuple(shards), sizes, files, sum(r["tokens"] for r in rows), sum(r["n_words"] for r in rows))


# ---- scoring ----

class Shard:
    """Some segments of a model in memory."""

    def __init__(self, model: BigramModel, first: int, last: int):
        sizes = np.array(model.sizes[first:last + 1], np.int64)
        self.first, (self.sizes, n_words) = first, sizes.T
        self.starts, self.word_starts = (np.cumsum(n) - n for n in (self.sizes, n_words))
        self.n_words = n_words
        self.filter = np.zeros(int(self.sizes.sum()), np.uint64)
        self.words, self.counts = np.empty(int(n_words.sum()), np.uint64), np.empty(int(n_words.sum()), np.int64)
        system, path = fs.FileSystem.from_uri(model.path)
        columns = ["segment", "filter", "words", "counts"]
        # A file, which has a few segments, at a time into the arrays: no second copy of the shard.
        for file in sorted({file for file in model.files[first:last + 1] if file}):
            with system.open_input_file(f"{path}/{file}") as source:
                rows = pq.ParquetFile(source).read(columns=columns, use_threads=False)
            for segment, *parts in zip(*(rows.column(c) for c in columns), strict=True):
                if not first <= segment.as_py() <= last:
                    continue
                i = segment.as_py() - first
                for target, start, part in zip((self.filter, self.words, self.counts),
                                               (self.starts[i], self.word_starts[i], self.word_starts[i]), parts, strict=True):
                    values = np.frombuffer(part.as_buffer(), target.dtype)
                    target[start:start + len(values)] = values

    def exact(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Counts of distinct, sorted keys: each segment's words are sorted too."""
        found = np.zeros(len(keys), np.int64)
        order = np.argsort(segment, kind="stable")
        cuts = np.searchsorted(segment[order], np.arange(self.first, self.first + len(self.sizes) + 1))
        for i, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            words = self.words[self.word_starts[i]:self.word_starts[i] + self.n_words[i]]
            if hi > lo and len(words):
                rows = order[lo:hi]
                at = np.minimum(np.searchsorted(words, keys[rows]), len(words) - 1)
                found[rows] = np.where(words[at] == keys[rows], self.counts[self.word_starts[i]:][at], 0)
        return found

    def quantised(self, keys: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """How many events of each key the filter has, from the first on: probes go on until one misses."""
        local = segment - self.first
        levels = np.zeros(len(keys), np.int64)
        rows = np.arange(len(keys))
        level = 1
        while len(rows):
            word, mask = _event(keys, level, self.sizes[local])
            hit = (self.filter[self.starts[local] + word] & mask) == mask
            rows, keys, local = rows[hit], keys[hit], local[hit]
            levels[rows] = level
            level += 1
            if level > 64:
                break
        return levels


_RESIDENT: dict[tuple, Shard] = {}


def _shard(model: BigramModel, bounds: tuple[int, int]) -> Shard:
    """The last shard used stays with the worker process."""
    if (model.path, bounds) not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[model.path, bounds] = Shard(model, *bounds)
    return _RESIDENT[model.path, bounds]


def expected_count(levels: np.ndarray) -> np.ndarray:
    """The count a number of events stands for: the geometric middle of its range, and 1 exactly for one event."""
    return np.where(levels > 1, np.exp2(levels - 0.5), levels.astype(np.float64))


class _Held:
    """Arrays in memory up to a bound, and beyond it in a temporary file of the worker."""

    def __init__(self):
        self.bytes, self.file = 0, None

    def put(self, values: np.ndarray) -> np.ndarray | tuple[int, np.dtype, int]:
        if self.bytes + values.nbytes <= _HELD_BYTES:
            self.bytes += values.nbytes
            return values
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        at = self.file.seek(0, 2)
        self.file.write(np.ascontiguousarray(values).data)
        return at, values.dtype, len(values)

    def get(self, held: np.ndarray | tuple[int, np.dtype, int], start: int = 0, end: int | None = None) -> np.ndarray:
        if isinstance(held, np.ndarray):
            return held[start:end]
        at, dtype, n = held
        self.file.seek(at + start * dtype.itemsize)
        return np.frombuffer(self.file.read(((n if end is None else end) - start) * dtype.itemsize), dtype)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Probes:
    """Keys in the order of their segments, and what the shards say of them, shard by shard."""

    def __init__(self, model: BigramModel, keys: np.ndarray, held: _Held, exact: bool):
        segment = _segment_of(keys, model.segments)
        order = np.argsort(segment.astype(np.uint16) if model.segments <= 1 << 16 else segment, kind="stable")
        self.cuts = np.searchsorted(segment[order], [*(first for first, _ in model.shards), model.segments])
        self.held, self.exact = held, exact
        self.keys, self.order = held.put(keys[order]), held.put(order.astype(np.int32))
        self.levels, self.counts = [], []

    def ask(self, shard: Shard, i: int, segments: int) -> None:
        keys = self.held.get(self.keys, self.cuts[i], self.cuts[i + 1])
        segment = _segment_of(keys, segments)
        levels = [shard.quantised(keys[j:j + _PROBED_AT_ONCE], segment[j:j + _PROBED_AT_ONCE]).astype(np.uint8)
                  for j in range(0, len(keys), _PROBED_AT_ONCE)]
        self.levels += [self.held.put(x) for x in levels]
        if self.exact and len(keys):
            self.counts.append(self.held.put(shard.exact(keys, segment)))

    def _answers(self, parts: list, dtype: type) -> np.ndarray:
        found = np.concatenate([self.held.get(x) for x in parts] or [np.empty(0, dtype)])
        values = np.empty(len(found), dtype)
        values[self.held.get(self.order)] = found
        return values

    def answers(self) -> tuple[np.ndarray, np.ndarray]:
        """Levels of the keys in their own order, and their counts if these were asked for."""
        return self._answers(self.levels, np.int64), self._answers(self.counts, np.int64) if self.exact else np.empty(0, np.int64)


def _score(model: BigramModel, prior: float):
    scale = model.tokens + 1 * (model.vocabulary + 1)

    def scored(gathered: list[tuple], held: _Held) -> Iterator[pa.RecordBatch]:
        for i, bounds in enumerate(model.shards):
            shard = _shard(model, bounds)
            for _, _, _, _, words, pairs in gathered:
                words.ask(shard, i, model.segments)
                pairs.ask(shard, i, model.segments)
        while gathered:
            ids, sizes, place, end, words, pairs = gathered.pop(0)
            starts = np.cumsum(sizes) - sizes
            place = held.get(place)
            levels, counts = words.answers()
            exact, seen = counts[place], expected_count(levels)
            word = seen[place]
            history = _before(word, sizes, seen[end])  # a start for every end
            pair = expected_count(pairs.answers()[0])
            pair = np.minimum(pair, np.minimum(history, word))  # no count exceeds those of its words
            chance = (pair + prior * (word + 1) / scale) / (history + prior)
            yield pa.RecordBatch.from_arrays(
                [*ids, pa.array(sizes),
                 pa.array(np.add.reduceat((exact > 0).astype(np.int64), starts)),
                 pa.array(np.full(len(sizes), model.tokens, np.int64)),
                 pa.array(np.add.reduceat(np.log10((exact + 1) / scale), starts)),
                 pa.array(np.add.reduceat(np.log10(np.minimum(chance, 1.0)), starts))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, held, total = [], _Held(), 0
        try:
            for table, tokens, sizes in _text_chunks(batches):
                # Copies of the few columns: slices would keep the texts they came with.
                ids = [table.column(c).combine_chunks().take(pa.array(np.arange(len(sizes)))) for c in ("doc_id", "held_out")]
                distinct, place = np.unique(tokens, return_inverse=True)
                pairs = _Probes(model, bigram_hashes(tokens, sizes), held, exact=False)
                words = _Probes(model, distinct, held, exact=True)
                end = int(np.searchsorted(distinct, END))  # every text has one
                gathered.append((ids, sizes, held.put(place.astype(np.int32)), end, words, pairs))
                total += len(tokens)
                del table, tokens
                if total >= _GROUP_TOKENS:
                    yield from scored(gathered, held)
                    held.close()
                    gathered, held, total = [], _Held(), 0
            if gathered:
                yield from scored(gathered, held)
        finally:
            held.close()

    return run


def score(docs: DataFrame, model: BigramModel, text: str = "text", key: str = "doc_id", held_out: Column | None = None,
          prior: float = 20.0) -> DataFrame:
    """Per row: tokens, known tokens, the add-one unigram base score and the bigram model's score, both log10.

    P(w | h) = (c(hw) + prior * P(w)) / (c(h) + prior) with P(w) add-one smoothed; an end closes every text and
    opens none.  Null texts are empty (their end is scored), repeated rows and null ids are rows like any other.
    """
    own = docs.select(F.col(key).cast("long").alias("doc_id"), (F.lit(False) if held_out is None else held_out).alias("held_out"),
                      F.coalesce(F.col(text), F.lit("")).alias("text"))
    return own.mapInArrow(_score(model, prior), _SCORES)


def remainder(key: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo: the split into training and held-out rows (a null id: 0)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % divisor, F.lit(0))
