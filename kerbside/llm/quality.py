"""Quality scores by nearest-neighbour voting over latent-semantic vectors.

A text becomes counts of hashed character-class trigrams and a few facts of its shape.  A bounded sample of
labelled texts gives term weights and the leading singular vectors; its projected vectors are the voters.  They
are broadcast (their number is the bound), and every document meets all of them in blocked matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.simhash import words_of

N_TRIGRAMS = 2048
_RATIOS = 12  # steps of a share
_LENGTHS = 24  # powers of two
N_TERMS = N_TRIGRAMS + 2 * _RATIOS + _LENGTHS
_BLOCK = 512  # documents of one matrix product


def _classes() -> np.ndarray:
    """Lower-case letters, capitals and digits as one class each, other ASCII as itself, all beyond ASCII as one."""
    table = np.arange(256, dtype=np.int64)
    table[ord("a"):ord("z") + 1] = ord("a")
    table[ord("A"):ord("Z") + 1] = ord("A")
    table[ord("0"):ord("9") + 1] = ord("0")
    table[128:] = 1
    return table


CLASSES = _classes()


def term_counts(text: str) -> np.ndarray:
    """Weights of one whole text's terms, of unit length before idf."""
    data = text.encode("utf-8", "surrogatepass")
    row = np.zeros(N_TERMS, np.float32)
    kinds = CLASSES[np.frombuffer(data, np.uint8)]
    if len(kinds) >= 3:
        grams = (kinds[:-2] * 16381 + kinds[1:-1] * 127 + kinds[2:]) % N_TRIGRAMS
        counts = np.log1p(np.bincount(grams, minlength=N_TRIGRAMS))
        row[:N_TRIGRAMS] = counts / (np.linalg.norm(counts) or 1.0)
    words, lines = words_of(text), text.split("\n")
    for i, (distinct, all_of) in enumerate(((len(set(words)), len(words)), (len(set(lines)), len(lines)))):
        row[N_TRIGRAMS + i * _RATIOS + min(_RATIOS - 1, int(_RATIOS * distinct / max(all_of, 1)))] = 0.3
    row[N_TRIGRAMS + 2 * _RATIOS + min(_LENGTHS - 1, len(words).bit_length())] = 0.1
    return row


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [term_counts(t or "").astype(np.float16).tobytes() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())],
                                         names=["doc_id", "label", "terms"])


@dataclass(frozen=True)
class Voters:
    """Projection from terms to the latent space, and the labelled vectors in it."""

    projection: np.ndarray  # terms x rank, idf folded in
    vectors: np.ndarray  # voters x rank, unit length
    labels: np.ndarray  # 0 or 1
    neighbours: int
    sharpness: float

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest voters, each weighted by a power of its cosine."""
        if not len(self.vectors):
            return np.full(len(terms), 0.5)
        vectors = _unit(terms @ self.projection)
        cosine = vectors @ self.vectors.T
        k = min(self.neighbours, cosine.shape[1])
        near = np.argpartition(cosine, cosine.shape[1] - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0.0) ** self.sharpness
        # The sample's own share stands in where no voter is near.
        total = weight.sum(axis=1) + 1e-6
        return np.clip(((weight * self.labels[near]).sum(axis=1) + 1e-6 * self.labels.mean()) / total, 0.0, 1.0)


def _leading_vectors(rows: np.ndarray, rank: int, rounds: int = 8) -> np.ndarray:
    """Right singular vectors of the largest singular values, by subspace iteration from a fixed start."""
    basis = np.random.default_rng(5).standard_normal((rows.shape[1], rank)).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(rows.T @ (rows @ basis)) if len(rows) else np.linalg.qr(basis)
    return basis


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", key: str = "doc_id",
        most: int = 4096, rank: int = 48, neighbours: int = 25, sharpness: float = 8.0) -> Voters:
    """Voters from at most ``most`` labelled documents, chosen by a hash of their id.

    Rows with a null id or another label than 0 and 1 are passed over; an id labelled twice counts once, with its
    smallest label.  Without any labelled document every score is one half.
    """
    usable = labels.select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    one_each = usable.groupBy("doc_id").agg(F.min("label").alias("label"))
    known = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = one_each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = known.join(F.broadcast(sample), "doc_id").mapInArrow(  # at most ``most`` ids
        _terms, "doc_id long, label int, terms binary").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    terms = np.stack([np.frombuffer(r["terms"], np.float16) for r in rows]).astype(np.float32) if rows else np.zeros((0, N_TERMS), np.float32)
    idf = np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    projection = _leading_vectors(terms * idf, rank) * idf[:, None]
    return Voters(projection, _unit(terms @ projection), np.array([r["label"] for r in rows], np.float32), neighbours, sharpness)


def _vote(voters, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(start, _BLOCK)
                terms = np.stack([term_counts(t or "") for t in part.column(text).to_pylist()])
                score = pa.array(voters.value.scores(terms).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*part.columns, score], names=[*part.schema.names, "score"])

    return run


def scored(docs: DataFrame, voters: Voters, columns: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """``columns`` of every row with the score of its whole text (null: empty), 0 to 1, higher if label 1 is likelier.

    Only the text is looked at; repeated rows and null ids are rows like any other.
    """
    given = list(dict.fromkeys([*columns, text]))
    numbered = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(given)])  # no name clashes with the score
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema]
    shared = docs.sparkSession.sparkContext.broadcast(voters)
    voted = numbered.mapInArrow(_vote(shared, f"c{given.index(text)}"), ", ".join([*fields, "score double"]))
    return voted.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], F.col("score").alias(out))
