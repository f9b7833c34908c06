"""Prefix trie of conversations, with totals of subtrees from an Euler tour.

Every distinct sequence of first turns is a node.  Its key is the exclusive or of 128-bit hashes of its turns, each
hashed with its place, so a prefix's key follows from running totals and long conversations are shared between tasks.
The tour has an enter and an exit arc for every node; each arc knows the next one from the node's place among its
siblings.  List ranking turns that into positions, and prefix sums at a node's two arcs give the leaves and savings
of its subtree.  Siblings come in the order of their keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.list_ranking import LIMIT, list_ranks, prefix_sums
from kerbside.llm.reading_order import numbered
from kerbside.llm.scratch import stored

NODE, PARENT = ["p1", "p2"], ["q1", "q2"]
_BLOCK = 1 << 12  # turns of a conversation that one window adds up
_CHUNK = 1 << 14  # ids joined to a text that travels
NOTHING = hashlib.sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, n, e1, e2, n_bytes): turns numbered from 1 by turn (null first, ties by a hash of role and text)."""
    what = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    slim = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(*what).alias("e1"), F.xxhash64(F.lit(1), *what).alias("e2"),
        F.octet_length(what[1]).cast("long").alias("n_bytes"))
    return numbered(stored(slim, "turns"), "n", ["turn", "e1", "e2"], "conv_id").drop("turn")


def spliced(turns: DataFrame, every: int, head: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on their host's first turns: the turns (with ``d`` for their place and ``size`` for the
    length), and (conv_id, size) of all conversations.  Host of c: c - c % every; turns taken: crc32(c) % head."""
    lengths = stored(turns.groupBy("conv_id").agg(F.max("n").alias("own")), "lengths")
    c = F.col("conv_id")
    wanted = lengths.withColumns({"host": c - c % every, "h": F.crc32(c.cast("string")) % head})
    hosts = lengths.select(F.col("conv_id").alias("host"), F.col("own").alias("host_own"))
    m = F.least("h", F.coalesce("host_own", F.lit(0)))
    plans = stored(wanted.join(hosts, "host", "left").select(
        "conv_id", "host", "h", m.alias("m"), (m + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size")), "splices")
    lent = turns.where((c % every == 0) & (F.col("n") < head)).withColumnRenamed("conv_id", "host")
    first = lent.join(plans, "host").where(F.col("n") <= F.col("m")).withColumn("d", F.col("n"))
    rest = turns.join(plans, "conv_id").where(F.col("n") > F.col("h")).withColumn("d", F.col("m") + F.col("n") - F.col("h"))
    columns = ["conv_id", "d", "size", "e1", "e2", "n_bytes"]
    return first.select(columns).unionByName(rest.select(columns)), plans.select("conv_id", "size")


def with_prefix_keys(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, d, e1, e2, ..) with the keys of the prefix that ends here (p1, p2) and of the one before it."""
    tagged = turns.withColumns({"t1": F.xxhash64("d", "e1", "e2"), "t2": F.xxhash64("d", "e2", "e1"), "_block": F.floor(F.col("d") / _BLOCK)})
    inside = Window.partitionBy("conv_id", "_block").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    keyed = stored(tagged.withColumns({"p1": F.bit_xor("t1").over(inside), "p2": F.bit_xor("t2").over(inside)}), "prefixes")
    totals = keyed.groupBy("conv_id", "_block").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    moved = stored(totals.select("conv_id", "_block", F.bit_xor("x1").over(before).alias("x1"), F.bit_xor("x2").over(before).alias("x2"))
                   .where(F.col("_block") > 0), "prefix-offsets")
    whole = keyed.join(moved, ["conv_id", "_block"], "left")

    def shifted(k: str) -> Column:
        return F.col(f"p{k}").bitwiseXOR(F.coalesce(F.col(f"x{k}"), F.lit(0)))

    return whole.select("conv_id", "d", "size", "n_bytes", shifted("1").alias("p1"), shifted("2").alias("p2"),
                        shifted("1").bitwiseXOR(F.col("t1")).alias("q1"), shifted("2").bitwiseXOR(F.col("t2")).alias("q2"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each node's id texts, which come one after another in order; one text is held at a time."""
    key, digest = None, None
    for batch in batches:
        done: list[tuple[int, int, str]] = []
        for p1, p2, ids in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "ids")), strict=True):
            if (p1, p2) == key:
                digest.update(b",")
            else:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (p1, p2), hashlib.sha256()
            digest.update(ids.encode())
        yield _digest_rows(done)
    yield _digest_rows([(*key, digest.hexdigest())] if key is not None else [])


def _digest_rows(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)],
                                      names=[*NODE, "ends_sha256"])


def member_digests(members: DataFrame) -> DataFrame:
    """(p1, p2, ends_sha256) from (p1, p2, conv_id): SHA-256 of each node's ids, ascending and joined by commas.

    Ids are joined by spans of ``_CHUNK`` values.  A node of one span is done where it stands; the spans of a larger one
    come one after another in one task, as the digest asks for, a text of thousands of ids a row.
    """
    span = F.floor(F.col("conv_id") / _CHUNK)
    chunks = stored(members.groupBy(*NODE, span.alias("span")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids")), "id-spans")
    spans = stored(chunks.groupBy(*NODE).agg(F.count("*").alias("spans")).where("spans > 1").drop("spans"), "wide-nodes")
    one = chunks.join(spans, NODE, "left_anti").select(*NODE, F.sha2("ids", 256).alias("ends_sha256"))
    many = chunks.join(spans, NODE, "left_semi").repartition(*NODE).sortWithinPartitions(*NODE, "span").select(*NODE, "ids")
    return one.unionByName(many.mapInArrow(_digests, "p1 long, p2 long, ends_sha256 string"))


def trie_nodes(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (v, p1, p2, q1, q2, depth, conv_id, n_convs, n_bytes), numbered from 0 so that siblings are neighbours, and
    (p1, p2, conv_id) of where every conversation ends.  The root has the key 0 and a null parent."""
    rows = stored(with_prefix_keys(turns), "prefix-keys")
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    below = rows.groupBy(*NODE).agg(
        F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.first("d").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"), F.first("n_bytes").alias("n_bytes"))
    root = sizes.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where(F.col("n_convs") > 0).select(
        zero.alias("p1"), zero.alias("p2"), none.alias("q1"), none.alias("q2"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("n_bytes"))
    nodes = numbered(stored(below.unionByName(root), "nodes"), "v", [*PARENT, *NODE]).withColumn("v", F.col("v") - 1)
    ends = rows.where(F.col("d") == F.col("size")).select(*NODE, "conv_id").unionByName(
        sizes.where(F.col("size") == 0).select(zero.alias("p1"), zero.alias("p2"), "conv_id"))
    return stored(nodes, "numbered-nodes"), ends


def tour(nodes: DataFrame, families: DataFrame) -> DataFrame:
    """(id, succ) of the Euler tour: node v is entered by arc 2v and left by arc 2v + 1; the root's exit is the last."""
    first = families.select(*NODE, F.col("first").alias("child"))
    own = families.select("last", F.col("v").alias("parent"))
    around = nodes.select("v", *NODE).join(first, NODE, "left").join(own, F.col("v") == F.col("last"), "left")
    enter = F.struct((2 * F.col("v")).alias("id"), F.coalesce(2 * F.col("child"), 2 * F.col("v") + 1).alias("succ"))
    sibling = F.when(F.col("v") > 0, 2 * F.col("v") + 2)
    leave = F.struct((2 * F.col("v") + 1).alias("id"), F.coalesce(2 * F.col("parent") + 1, sibling).alias("succ"))
    return around.select(F.inline(F.array(enter, leave)))


def conversation_trie(conversations: DataFrame, every: int = 5, head: int = 9, limit: int = LIMIT) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    Null roles and texts are empty, turns that tie go by a hash of role and text, repeated rows are turns like any other,
    rows without a conversation id belong to none, and a table without conversations has no node, not even the root.
    """
    turns, sizes = spliced(stored(ordered_turns(conversations), "ordered-turns"), every, head)
    nodes, ends = trie_nodes(turns, sizes)
    groups = nodes.where(F.col("v") > 0).groupBy(*PARENT).agg(
        F.min("v").alias("first"), F.max("v").alias("last"), F.count("*").alias("n_children")).withColumnsRenamed({"q1": "p1", "q2": "p2"})
    families = stored(groups.join(nodes.select(*NODE, "v", F.col("conv_id").alias("parent_conv_id")), NODE), "families")

    placed = list_ranks(tour(nodes, families), limit)
    enters, v = F.col("id") % 2 == 0, F.floor(F.col("id") / 2)
    known = nodes.join(families.select(*NODE, "n_children"), NODE, "left").select(
        "v", F.col("n_children").isNull().cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    valued = placed.withColumn("v", v).join(known, "v").select(
        "v", "rank", enters.alias("enters"), F.when(enters, F.col("leaves")).otherwise(0).alias("leaves"),
        F.when(enters, F.col("saved")).otherwise(0).alias("saved"), F.when(enters, F.col("leaves")).otherwise(0).alias("own_leaf"),
        F.when(enters, F.col("saved")).otherwise(0).alias("own_saved"))
    sums = prefix_sums(valued, "rank", ["leaves", "saved"])

    def within(total: str, own: str) -> Column:
        """At the exit, less what came before the enter arc."""
        return F.sum(F.when(F.col("enters"), F.col(own) - F.col(total)).otherwise(F.col(total)))

    subtrees = sums.groupBy("v").agg(within("leaves", "own_leaf").alias("n_leaves"), within("saved", "own_saved").alias("saved_tokens"))
    parents = families.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), "parent_conv_id")
    return (nodes.join(subtrees, "v").join(families.select(*NODE, "n_children"), NODE, "left")
            .join(stored(member_digests(ends), "member-digests"), NODE, "left").join(parents, PARENT, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
                    "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")))
