"""Spelling variants of a corpus' words by reduced-alphabet generation.

Letters are folded onto ``SYMBOLS`` symbols.  An edit of one letter changes the folded word by one edit or not at all,
so the full one-edit neighbourhood of every folded word, joined with the folded vocabulary, brings all near words
together; the words themselves decide.  A bitmap of fixed size with the codes of the vocabulary keeps most neighbours that
are no word's code from travelling; as the vocabulary grows it lets more through and loses nothing.  Neighbours are generated as 64-bit codes of the folded words (sums of a number
per symbol and place from either end), so each costs the same however long the word is, and no string is built.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.scratch import stored

# What a run of letters is, and capitals that are folded.
RUN = r"[A-Za-zÀ-ÿ]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = 8
BITS = 26
_STEP = 1 << 13  # letters of a word whose neighbours are made at once
_CELLS = 1 << 21  # codes made at once
_BASE = 0x9E3779B97F4A7C15


def lower_ascii(text: Column) -> Column:
    return F.translate(text, CAPITALS, CAPITALS.lower())


def damaged_runs(docs: DataFrame, text: str, key: str, every: int) -> DataFrame:
    """A column ``word``: every run of letters of the whole texts; one of ``every`` (by a checksum of id and run) has
    lost the letter that the checksum names."""
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RUN), F.lit(0))).alias("run"))
    hashed = runs.select(lower_ascii(F.col("run")).alias("run"), "id").withColumn("h", F.crc32(F.concat_ws(":", "id", "run")))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    return hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, text: str = "text", key: str = "doc_id", every: int = 31, min_chars: int = 7,
               min_count: int = 2) -> DataFrame:
    """word and n of every word of ``min_chars`` letters that occurs ``min_count`` times or more."""
    words = damaged_runs(docs, text, key, every).where(F.char_length("word") >= min_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _symbols(word: str) -> np.ndarray:
    """Symbol of each letter; neighbouring letters of the alphabet get different ones."""
    return (np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32) % SYMBOLS).astype(np.int64)


def _powers(n: int) -> np.ndarray:
    powers = np.ones(n + 1, np.uint64)
    np.multiply.accumulate(np.full(n, _BASE, np.uint64), out=powers[1:])
    return powers


def _halves(symbols: np.ndarray, powers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of symbols: codes of the first i letters, and what the letters from i on add to a code, for every i."""
    n, length = symbols.shape
    weighted = (symbols + 1).astype(np.uint64) * powers[length - 1 - np.arange(length)]
    ends = np.zeros((n, length + 1), np.uint64)
    ends[:, :length] = np.cumsum(weighted[:, ::-1], axis=1)[:, ::-1]
    starts = np.zeros((n, length + 1), np.uint64)
    for i in range(length):  # Horner's rule, all words at once
        starts[:, i + 1] = starts[:, i] * np.uint64(_BASE) + (symbols[:, i] + 1).astype(np.uint64)
    return starts, ends


def neighbour_codes(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, code) of the distinct folded words within one edit of each row of symbols, itself included.

    Of equal results one is made: the first of a run of equal symbols is deleted, and a symbol is inserted only where
    the one before it differs.
    """
    n, length = symbols.shape
    powers = _powers(length + 1)
    starts, ends = _halves(symbols, powers)
    rows = np.arange(n)
    yield rows, starts[:, length]
    for lo in range(0, length + 1, _STEP):
        at = np.arange(lo, min(lo + _STEP, length + 1))
        inside = at[at < length]
        before = np.concatenate([np.full((n, 1), -1), symbols], axis=1)[:, at]  # symbol before each place, -1 at the start
        own = symbols[:, inside]
        one_less, kept = ends[:, inside + 1], powers[length - 1 - inside]
        made, mask = [starts[:, inside] * kept + one_less], [own != before[:, :len(inside)]]
        for symbol in range(SYMBOLS):
            code = np.uint64(symbol + 1)
            made.append((starts[:, inside] * np.uint64(_BASE) + code) * kept + one_less)
            mask.append(own != symbol)
            made.append((starts[:, at] * np.uint64(_BASE) + code) * powers[length - at] + ends[:, at])
            mask.append(before != symbol)
        for codes, use in zip(made, mask, strict=True):
            row, column = np.nonzero(use)
            yield row, codes[row, column]


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, _CELLS // (2 * SYMBOLS * int(length)))
        for start in range(0, len(rows), step):
            part = rows[start:start + step]
            yield part, np.stack([_symbols(words[i]) for i in part])


def _slot(codes: np.ndarray) -> np.ndarray:
    mixed = (codes ^ (codes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed >> np.uint64(64 - BITS)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word of the bitmap, bits set in it) of the codes of each batch."""
    for batch in batches:
        slots = np.unique(_slot(batch.column("code").to_numpy().view(np.uint64)))
        if len(slots):
            at, starts = np.unique(slots >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (slots & np.uint64(63)), starts)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(bits.view(np.int64))], names=["at", "bits"])


def code_bitmap(named: DataFrame) -> np.ndarray:
    """2**BITS bits (8 MB, whatever the vocabulary), set where a code of ``named`` falls."""
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    parts = named.select("code").mapInArrow(_bits, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    rows = parts.toArrow()
    bitmap[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return bitmap


def _neighbours(bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value
        for batch in batches:
            words, ids = batch.column("word").to_pylist(), batch.column("id").to_numpy()
            for part, symbols in _by_length(words):
                for row, codes in neighbour_codes(symbols):
                    slot = _slot(codes)
                    met = np.flatnonzero(known[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[part[row[met]]]), pa.array(codes[met].view(np.int64))], names=["id", "code"])

    return run


def folded_codes(words: list[str]) -> np.ndarray:
    """A word's code: its symbols, read as a number in base ``_BASE`` modulo 2**64."""
    codes = np.zeros(len(words), np.uint64)
    for part, symbols in _by_length(words):
        codes[part] = _halves(symbols, _powers(symbols.shape[1]))[0][:, -1]
    return codes


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = folded_codes(batch.column("word").to_pylist()).view(np.int64)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "word", "n")), pa.array(codes)],
                                         names=["id", "word", "n", "code"])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for every two words of (word, n) that differ by exactly one inserted, deleted or replaced
    code point, in both directions.  ``words`` holds each word once."""
    named = stored(words.select(F.xxhash64("word").alias("id"), "word", "n").mapInArrow(
        _codes, "id long, word string, n long, code long"), "folded-words")
    bitmap = words.sparkSession.sparkContext.broadcast(code_bitmap(named))
    around = named.select("id", "word").mapInArrow(_neighbours(bitmap), "id long, code long")
    # A word's neighbours have distinct codes, so a pair meets once; the other word travels with it.
    others = named.select(F.col("id").alias("other"), "code", F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = around.join(others, "code").where("id <> other").select("id", "near", "near_n")
    return met.join(named.select("id", "word", "n"), "id").where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, by doubling; counts rise tenfold at every step, so
    ways are short."""
    links = stored(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                  F.col("next").isNotNull().alias("moved")), "forms")
        if longer.where("moved").isEmpty():
            break
        links = longer.select("word", "root")
    return forms.join(links, "word", "left").select("word", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", every: int = 31, min_chars: int = 7,
                      min_count: int = 2, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    A word's form is the near word of largest count (the smallest in code-point order of equals) if that count is
    ``times`` its own or more.  Null texts have no words, a null id is written as nothing before the run, repeated rows
    count again, and a table without words gives an empty result.
    """
    words = stored(vocabulary(docs, text, key, every, min_chars, min_count), "vocabulary")
    near = near_words(words)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    judged = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    is_form = F.col("near_n") >= times * F.col("n")
    forms = stored(judged.select("word", "n", "n_near", F.when(is_form, F.col("near")).alias("form"),
                                 F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-forms")
    return forms.join(roots(forms.select("word", "form")), "word").select("word", "form", "root", "n", "n_near", "form_n")
