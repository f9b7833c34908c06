"""Ranks of the elements of a linked list that lies spread over a cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.scratch import scratch_path, stored

LIMIT = 1 << 16  # elements that one task ranks in memory
_RANKS = "id long, rank long"


def _rank_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follows one whole list of at most ``LIMIT`` elements by pointer doubling."""
    parts = list(batches)
    if not sum(p.num_rows for p in parts):
        return
    rows = pa.Table.from_batches(parts)
    ids = rows.column("id").to_numpy()
    succ = rows.column("succ").fill_null(-1).to_numpy()
    order = np.argsort(ids)
    at = np.where(succ < 0, len(ids), order[np.minimum(np.searchsorted(ids, succ, sorter=order), len(ids) - 1)])
    at = np.r_[at, len(ids)]
    ahead = np.r_[rows.column("w").to_numpy(), 0]  # what lies between an element and the list's end
    ahead[:-1][succ < 0] = 0
    while (at < len(ids)).any():
        ahead, at = ahead + ahead[at], at[at]
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ahead.max() - ahead[:-1])], names=["id", "rank"])


def list_ranks(links: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(id, rank) of every element, from (id, succ): the first has rank 0, the last a null ``succ``.

    ``links`` must be one list.  A round tosses a coin per element; an element with heads takes the place of a successor
    with tails, so about a quarter goes each round, and a round is one join.  What is left, ``limit`` elements at most,
    is ranked in one task, and the others are put back in the opposite order of their going.
    """
    session = links.sparkSession
    rest = stored(links.select("id", "succ", F.lit(1).cast("long").alias("w")), "list")
    gone: list[DataFrame] = []
    while rest.count() > limit:
        def tails(element: str, turn: int = len(gone)) -> Column:
            return F.xxhash64(F.lit(turn), element).bitwiseAND(1) == 1

        taking = rest.where(~tails("id") & F.col("succ").isNotNull() & tails("succ"))
        waiting = rest.where(tails("id"))
        others = rest.where(~tails("id") & (F.col("succ").isNull() | ~tails("succ")))
        none = F.lit(None).cast("long")
        pairs = waiting.join(taking.select(F.col("id").alias("by"), F.col("succ").alias("id"), F.col("w").alias("gap")), "id", "left")
        merged = F.struct(F.coalesce("by", "id").alias("id"), F.col("succ"), (F.coalesce("gap", F.lit(0)) + F.col("w")).alias("w"), none.alias("by"))
        left = F.struct(F.col("id"), none.alias("succ"), F.col("gap").alias("w"), F.col("by"))
        outcome = pairs.select(F.inline(F.when(F.col("by").isNull(), F.array(merged)).otherwise(F.array(merged, left))))
        state = stored(others.select("id", "succ", "w", none.alias("by")).unionByName(outcome), "list")
        rest = state.where(F.col("by").isNull()).drop("by")
        gone.append(state.where(F.col("by").isNotNull()).select("id", "by", F.col("w").alias("gap")))
    paths = [scratch_path(session, "ranks")]
    rest.select("id", "succ", "w").coalesce(1).mapInArrow(_rank_all, _RANKS).write.parquet(paths[0])
    for back in reversed(gone):
        known = session.read.schema(_RANKS).parquet(*paths)
        paths.append(scratch_path(session, "ranks"))
        back.join(known.select(F.col("id").alias("by"), "rank"), "by").select(
            "id", (F.col("rank") + F.col("gap")).alias("rank")).write.parquet(paths[-1])
    return session.read.schema(_RANKS).parquet(*paths)


def prefix_sums(values: DataFrame, position: str, columns: list[str], block: int = 1 << 16) -> DataFrame:
    """Sums of ``columns`` up to and including each position; positions are dense from 0.

    Blocks of positions are summed up by a window each; one window runs over the blocks' totals.
    """
    placed = values.withColumn("_block", F.floor(F.col(position) / block))
    inside = Window.partitionBy("_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    totals = stored(placed.groupBy("_block").agg(*[F.sum(c).alias(f"_{c}") for c in columns]), "block-sums")
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    offsets = totals.select("_block", *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}") for c in columns])
    summed = placed.withColumns({c: F.sum(c).over(inside) for c in columns}).join(offsets, "_block")
    return summed.withColumns({c: F.col(c) + F.col(f"_{c}") for c in columns}).drop("_block", *[f"_{c}" for c in columns])
