"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph; recursive spectral bisection cuts it into parts of equal
size with few edges between them; a small network learns to tell a vector's part, and every vector is indexed under
its most probable one.  A second network learns in which parts a vector's neighbours ended up; it routes queries to
the most probable of these, and the candidates met there are ranked by exact cosine.

Equal vectors are one entry with its smallest ids, so copies of a frequent vector cannot fill a part.  A part's
entries and queries are cut into blocks; a task compares one block with one block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.scratch import stored

_BLOCK = 4096


# ---- learning ----

def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def neighbour_graph(vectors: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows by cosine of each row but itself (row numbers)."""
    near = np.empty((len(vectors), k), np.int64)
    for start in range(0, len(vectors), 512):
        cosine = vectors[start:start + 512] @ vectors.T
        cosine[np.arange(len(cosine)), start + np.arange(len(cosine))] = -np.inf
        near[start:start + 512] = np.argpartition(cosine, cosine.shape[1] - k, axis=1)[:, -k:]
    return near


def balanced_parts(near: np.ndarray, levels: int, seed: int = 7) -> np.ndarray:
    """2**levels parts of sizes that differ by one at most: each level halves every part at the median of its
    graph's second eigenvector (by power iteration), so that few edges are cut."""
    n, k = near.shape
    a, b = np.repeat(np.arange(n), k), near.ravel()
    part = np.zeros(n, np.int64)
    random = np.random.default_rng(seed)
    for _ in range(levels):
        inside = part[a] == part[b]
        x, y = a[inside], b[inside]
        degree = np.bincount(x, minlength=n) + np.bincount(y, minlength=n) + 1.0
        value = random.standard_normal(n)
        for _ in range(80):
            mean = np.bincount(part, value * degree) / np.bincount(part, degree)
            value -= mean[part]
            value = (value + np.bincount(x, value[y], n) + np.bincount(y, value[x], n)) / degree
            value /= (np.sqrt(np.bincount(part, value * value) / np.bincount(part)) + 1e-30)[part]
        order = np.lexsort((value, part))
        sizes = np.bincount(part)
        rank = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        upper = np.empty(n, np.int64)
        upper[order] = rank >= np.repeat((sizes + 1) // 2, sizes)
        part = part * 2 + upper
    return part


@dataclass(frozen=True)
class Router:
    """One hidden layer; rows of ``probabilities`` sum to one over the parts."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @property
    def parts(self) -> int:
        return len(self.out_bias)

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        return _softmax(np.maximum(vectors @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias)

    def best(self, vectors: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.probabilities(vectors), axis=1, kind="stable")[:, :n]


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_router(vectors: np.ndarray, targets: np.ndarray, width: int = 128, epochs: int = 30, seed: int = 7) -> Router:
    """Cross-entropy against each row's distribution over parts, by Adam on mini-batches."""
    random = np.random.default_rng(seed)
    dim, parts = vectors.shape[1], targets.shape[1]
    weights = [random.standard_normal((dim, width)) * np.sqrt(2 / dim) * 3, np.zeros(width),
               random.standard_normal((width, parts)) * np.sqrt(1 / width), np.zeros(parts)]
    first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        order = random.permutation(len(vectors))
        for start in range(0, len(order), 128):
            x, y = vectors[order[start:start + 128]], targets[order[start:start + 128]]
            active = np.maximum(x @ weights[0] + weights[1], 0)
            error = (_softmax(active @ weights[2] + weights[3]) - y) / len(x)
            back = (error @ weights[2].T) * (active > 0)
            step += 1
            for i, slope in enumerate((x.T @ back, back.sum(0), active.T @ error, error.sum(0))):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope * slope
                rate = 0.004 * (1 - epoch / epochs)
                weights[i] -= rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*weights)


# ---- index and search ----

def _usable(table: DataFrame, key: str, column: str) -> DataFrame:
    """vec_id, v (doubles' floats as given) of the rows that take part."""
    v = F.col(column)
    sound = (F.col(key).isNotNull() & v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
             & F.exists(v, lambda x: x != 0))
    return table.where(sound).select(F.col(key).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("v").to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in batch.schema.names if c != "v"], pa.array([np.asarray(r, np.float64).tobytes() for r in rows], pa.binary())],
            names=[*[c for c in batch.schema.names if c != "v"], "v"])


def _matrix(packed) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1) if len(packed) else np.empty((0, 1))


def _route(router, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                best = router.value.best(_unit(_matrix(batch.column("v").to_pylist())), most)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                                                 names=[*batch.schema.names, "parts"])

    return run


def _compare(most: int):
    def run(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if entries.empty or queries.empty:
            return pd.DataFrame({"query": [], "node": [], "score": []}).astype({"query": "int64", "node": "int64", "score": "float64"})
        rows, asked = _matrix(entries["v"].tolist()), _matrix(queries["v"].tolist())
        rows_norm, first_id, node = np.linalg.norm(rows, axis=1), entries["first_id"].to_numpy(), entries["node"].to_numpy()
        out = []
        for start in range(0, len(asked), 512):
            block = asked[start:start + 512]
            block_norm = np.linalg.norm(block, axis=1)
            cosine = (block @ rows.T) / (block_norm[:, None] * rows_norm)
            bar = np.partition(cosine, max(0, cosine.shape[1] - most), axis=1)[:, max(0, cosine.shape[1] - most)]
            # Matrix products round in the order of their blocks; what may be among the best is summed again.
            q, r = np.nonzero(cosine >= bar[:, None] - 1e-12)
            s = np.einsum("ij,ij->i", block[q], rows[r]) / (block_norm[q] * rows_norm[r])
            order = np.lexsort((first_id[r], -s, q))
            q, r, s = q[order], r[order], s[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            keep = rank < most
            out.append(pd.DataFrame({"query": queries["node"].to_numpy()[start + q[keep]], "node": node[r[keep]], "score": s[keep]}))
        return pd.concat(out)

    return run


@dataclass(frozen=True)
class PartitionIndex:
    """Distinct vectors under their parts."""

    entries: DataFrame  # node, first_id, ids, v (packed doubles), part, block
    members: DataFrame  # vec_id, node of every usable row
    router: Router  # to the parts where a vector's neighbours are
    per_node: int

    def search(self, query_ids: DataFrame, k: int = 5, probes: int = 44, block: int = _BLOCK) -> DataFrame:
        """query_id, rank, vec_id, score: for each distinct id of ``query_ids`` (vec_id) its k nearest found, itself
        left out, by exact cosine in doubles, ties to the smaller id."""
        if k >= self.per_node:
            raise ValueError("the index keeps too few ids per vector for so many neighbours")
        session = self.entries.sparkSession
        asked = stored(self.members.join(query_ids.select("vec_id").distinct(), "vec_id"), "queries")
        nodes = self.entries.join(asked.select("node").distinct(), "node").select("node", "v")
        router = session.sparkContext.broadcast(self.router)  # a few weights per part
        routed = nodes.mapInArrow(_route(router, min(probes, self.router.parts)), "node long, v binary, parts array<int>").select(
            "node", "v", F.explode("parts").alias("part"))
        routed = stored(routed, "routed")
        # One row per part on either side: the parts are bounded, so these sizes are too.
        cuts = _cuts(self.entries, block).join(_cuts(routed, block).withColumnRenamed("cuts", "query_cuts"), "part")
        entry_rows = self.entries.join(F.broadcast(cuts), "part").withColumns({
            "eb": F.pmod(F.xxhash64("node", F.lit(1)), "cuts"), "qb": F.explode(F.sequence(F.lit(0), F.col("query_cuts") - 1))})
        query_rows = routed.join(F.broadcast(cuts), "part").withColumns({
            "qb": F.pmod(F.xxhash64("node", F.lit(1)), "query_cuts"), "eb": F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))})
        keys = ["part", "eb", "qb"]
        found = entry_rows.select(*[F.col(c).cast("long").alias(c) for c in keys], "node", "first_id", "v").groupBy(*keys).cogroup(
            query_rows.select(*[F.col(c).cast("long").alias(c) for c in keys], "node", "v").groupBy(*keys)).applyInPandas(
            _compare(k + 1), "query long, node long, score double")
        nearest = Window.partitionBy("query").orderBy(F.desc("score"), "first_id", "node")
        best = found.join(self.entries.select("node", "first_id", "ids"), "node").withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1)
        listed = best.select("query", F.explode("ids").alias("vec_id"), "score").groupBy("query").agg(
            F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("near"))
        own = asked.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query"))
        ranked = own.join(listed, "query").select("query_id", F.posexplode(F.slice(
            F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("pos", "hit"))
        return ranked.select("query_id", (F.col("pos") + 1).alias("rank"), "hit.vec_id", (-F.col("hit.far")).alias("score"))


def _cuts(rows: DataFrame, block: int) -> DataFrame:
    return rows.groupBy("part").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("cuts"))


def build_index(table: DataFrame, key: str = "vec_id", column: str = "embedding", levels: int = 6, sample: int = 16_384,
                graph_k: int = 10, per_node: int = 6) -> PartitionIndex:
    """Index every usable row: 2**levels parts learned from ``sample`` vectors chosen by hash.

    Null ids, null, empty or zero vectors, vectors with null or non-finite components, and vectors of another
    length than the commonest take no part; a repeated id counts as often as it stands there with other vectors.
    """
    session = table.sparkSession
    rows = _usable(table, key, column)
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = common["dim"] if common else 0
    plus_zero = F.transform("v", lambda x: x + F.lit(0.0))  # -0.0 and 0.0 are equal
    members = stored(rows.where(F.size("v") == dim).withColumn("v", plus_zero).withColumn("node", F.xxhash64("v")).distinct(), "members")
    smallest = members.withColumn("n", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))).where(F.col("n") <= per_node)
    grouped = smallest.groupBy("node").agg(
        F.min("vec_id").alias("first_id"), F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min_by("v", "vec_id").alias("v"))
    packed = stored(grouped.mapInArrow(_pack, "node long, first_id long, ids array<long>, v binary"), "vectors")

    chosen = packed.select("node", "v").orderBy(F.xxhash64("node", F.lit(3)), "node").limit(sample).collect()  # bounded
    vectors = _unit(_matrix([r["v"] for r in chosen]))
    parts = min(1 << levels, max(1, len(vectors) // 16))
    depth = int(np.log2(parts))
    if depth:
        near = neighbour_graph(vectors, min(graph_k, len(vectors) - 1))
        part, each = balanced_parts(near, depth), np.eye(1 << depth)
        indexer = train_router(vectors, (each[part] + each[part[near]].mean(axis=1)) / 2)
        indexed = indexer.best(vectors, 1)[:, 0]
        router = train_router(vectors, each[indexed[near]].mean(axis=1))
    else:
        indexer = router = Router(np.zeros((max(dim, 1), 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    routed = packed.mapInArrow(_route(session.sparkContext.broadcast(indexer), 1),
                               "node long, first_id long, ids array<long>, v binary, parts array<int>")
    entries = stored(routed.select("node", "first_id", "ids", "v", F.col("parts")[0].alias("part")), "parts")
    return PartitionIndex(entries, members.select("vec_id", "node"), router, per_node)
