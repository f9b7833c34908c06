"""Connected components by contraction, every round a stored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.scratch import stored


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a long, b long); nodes of one component share their root.

    Each round hooks a node to its smallest neighbour and contracts the edges.  The first round orders nodes by
    value, which finishes stars around their smallest node; later rounds order them by a fresh hash, so that long
    chains shrink by a constant share.  Hot nodes are safe: minima are taken before the shuffle and joins split.
    """
    session = edges.sparkSession
    rest = stored(edges.select("a", "b").where("a <> b").distinct(), "edges")
    hops: list[DataFrame] = []
    while not rest.isEmpty():
        rank = _rank(len(hops))
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(F.struct(rank(F.col("b")).alias("rank"), "b")).alias("near"))
        up = stored(near.select("a", F.when(
            F.struct(F.col("near.rank").alias("rank"), F.col("near.b").alias("b")) <
            F.struct(rank(F.col("a")).alias("rank"), F.col("a").alias("b")), F.col("near.b")).otherwise(F.col("a")).alias("up")), "hops")
        hops.append(up)
        rest = stored(
            rest.join(up, "a").select(F.col("up").alias("x"), F.col("b").alias("a")).join(up, "a")
            .select(F.least("x", "up").alias("a"), F.greatest("x", "up").alias("b")).where("a <> b").distinct(), "edges")
    if not hops:
        return session.createDataFrame([], "node long, root long")
    nodes = hops[0].select(F.col("a").alias("node"), F.col("up").alias("root"))
    for up in hops[1:]:
        nodes = nodes.join(up, nodes["root"] == up["a"], "left").select("node", F.coalesce("up", "root").alias("root"))
    return stored(nodes, "roots")


def _rank(turn: int):
    def rank(node: Column) -> Column:
        return node if turn == 0 else F.xxhash64(F.lit(turn), node)

    return rank
