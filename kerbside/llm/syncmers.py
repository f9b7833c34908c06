"""Document fingerprints from closed syncmers, with DataFrame functions only.

A run of ``SPAN`` = 15 code points is chosen if the smallest of its eight inner runs of eight is the first or the last
of them.  The choice looks at the run alone, so equal passages have the same anchors wherever they stand, an edit changes
only the anchors that cover it, and one of four runs is chosen on average.  The anchors of a text are therefore those
of any cut of it into pieces that overlap by 14 code points: long texts are worked through piece by piece, and an edited
text takes over the anchors of the part it keeps.

A fingerprint is the ``SKETCH`` smallest ranks of the distinct anchors, so it has a bounded size and merges: the sketch
of a union is that of the sketches' union.  Likeness is the Dice coefficient 2J / (1 + J) of the Jaccard similarity J
that two sketches show (exact for texts with at most ``SKETCH`` distinct anchors).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.reading_order import numbered
from kerbside.llm.scratch import stored

INNER = 8  # code points of an inner run, and inner runs of a run: three doublings
SPAN = 2 * INNER - 1
SKETCH = 128
PIECE = 1 << 10
BLOCK = 1 << 10  # places of the reading order whose fingerprints meet in one window


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _doubled(values: Column, join: Callable[[Column, Column], Column], times: int, body: Callable[[Column], Column]) -> Column:
    """``body`` of each element joined with the 2 ** ``times`` - 1 after it, by doublings; as many of the last mean nothing.

    The arrays between are bound where they are used: only what ``body`` makes is handed out, and copied on the way.
    """
    def from_step(i: int) -> Callable[[Column], Column]:
        if i == times:
            return body
        return lambda v: bound(F.zip_with(v, F.slice(v, (1 << i) + 1, F.greatest(F.size(v) - (1 << i), F.lit(0))), join), from_step(i + 1))

    return bound(values, from_step(0))


def _chosen(piece: Column, value: Callable[[Column, Column], Column]) -> Column:
    """Of each chosen run of a piece the value of its place and rank, by place."""
    def pick(inner: Column, low: Column) -> Column:
        # low: the least of four inner runs.  Most runs are passed over at a first comparison; arrays are shifted as a
        # whole before, so that a place finds what belongs to it without arithmetic.
        n_runs = F.greatest(F.size(low) - (SPAN - 1), F.lit(0))

        def at(lasts: Column, backs: Column) -> Callable[[Column, Column], Column]:
            def judged(front: Column, i: Column) -> Column:
                first, last, back = F.get(inner, i), F.get(lasts, i), F.get(backs, i)
                chosen = ((front == first) & (first <= back)) | ((back == last) & (last <= front))
                return F.when(chosen, value(i, F.shiftright(F.xxhash64(first, last), 32).cast("int")))
            return judged

        return bound(F.slice(inner, INNER, n_runs), lambda lasts: bound(F.slice(low, INNER // 2 + 1, n_runs), lambda backs: F.array_compact(
            F.transform(F.slice(low, 1, n_runs), at(lasts, backs)))))

    return _doubled(F.split(piece, ""), lambda a, b: F.xxhash64(a, b), 3, lambda inner: _doubled(
        inner, lambda a, b: F.least(a, b), 2, lambda low: pick(inner, low)))


def _pieces(text: Column, piece: int) -> Column:
    """A text cut into pieces that overlap, so that every run lies within one."""
    def with_overlap(cut: Column) -> Column:
        return F.transform(cut, lambda p, n: F.concat(p, F.coalesce(F.substring(F.get(cut, n + 1), 1, SPAN - 1), F.lit(""))))

    return bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{piece}}}"), F.lit(0)), with_overlap)


def anchors(text: Column, piece: int = PIECE) -> Column:
    """Array of (position, rank) of the chosen runs of a text, by position; empty below ``SPAN`` code points."""
    def anchor(start: Column) -> Callable[[Column, Column], Column]:
        return lambda i, rank: F.struct((start + i).alias("position"), rank.alias("rank"))

    return F.flatten(F.transform(_pieces(text, piece), lambda p, n: _chosen(p, anchor(n * piece))))


def sketch(text: Column, piece: int = PIECE) -> Column:
    """The smallest ranks of the distinct anchors of a text, ascending; empty below ``SPAN`` code points."""
    return bound(F.flatten(F.transform(_pieces(text, piece), lambda p: _chosen(p, lambda _, rank: rank))), smallest)


def smallest(ranks: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(ranks)), 1, SKETCH)


def whole_rank(text: Column) -> Column:
    """The one anchor of a text without a chosen run: all its code points."""
    return F.array(F.shiftright(F.xxhash64(text), 32).cast("int"))


def fingerprint(text: Column, parts: Column) -> Column:
    """The sketch of a text's parts, or its one anchor if no run was chosen."""
    return bound(parts, lambda ranks: F.when(F.size(ranks) == 0, whole_rank(text)).otherwise(ranks))


def printed(ranks: Column) -> Column:
    return F.array_join(F.transform(ranks, lambda r: F.lpad(F.lower(F.hex(r.cast("long").bitwiseAND(0xFFFFFFFF))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Of the ``SKETCH`` smallest ranks of both together the share that both have, as Dice coefficient."""
    def dice(both: Column) -> Column:
        return bound(F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both), lambda j: 2 * j / (1 + j))

    return bound(smallest(F.concat(a, b)), dice)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, sketch and fingerprint of every row's whole text (null: empty)."""
    own = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sketched = own.select("doc_id", fingerprint(F.col("text"), sketch(F.col("text"))).alias("sketch"))
    return sketched.withColumn("fingerprint", printed(F.col("sketch")))


def text_anchors(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, position and rank of every anchor of every row's whole text; short, empty and null texts have none."""
    return docs.select(F.col(key).alias("doc_id"), F.explode(anchors(F.coalesce(F.col(text), F.lit("")))).alias("a")).select(
        "doc_id", "a.position", "a.rank")


def shared_passages(pairs: DataFrame, docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = 4) -> DataFrame:
    """Positional matching: (a, b, start_a, start_b, length, n_anchors) of the passages that documents of a pair share.

    ``pairs`` has columns a and b, ids that are unique in ``docs``.  Anchors of a pair match at their first positions,
    one to one; matches with the same offset, and never more than ``4 * SPAN`` code points apart, make one passage.
    Passages of fewer than ``least`` anchors are left out.
    """
    wanted = stored(pairs.select("a", "b").distinct(), "pairs")
    both = wanted.select(F.col("a").alias("doc_id")).union(wanted.select(F.col("b").alias("doc_id"))).distinct()
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(both, "doc_id", "left_semi")
    firsts = stored(text_anchors(own).groupBy("doc_id", "rank").agg(F.min("position").alias("position")), "anchors")
    left = wanted.join(firsts.withColumnsRenamed({"doc_id": "a", "position": "at_a"}), "a")
    met = left.join(firsts.withColumnsRenamed({"doc_id": "b", "position": "at_b"}), ["b", "rank"])
    line = Window.partitionBy("a", "b", "offset").orderBy("at_a")
    apart = F.col("at_a") - F.lag("at_a").over(line) > 4 * SPAN
    runs = met.withColumn("offset", F.col("at_b") - F.col("at_a")).withColumn("_new", F.coalesce(apart, F.lit(False)).cast("int"))
    return runs.withColumn("_run", F.sum("_new").over(line)).groupBy("a", "b", "offset", "_run").agg(
        F.min("at_a").alias("start_a"), F.min("at_b").alias("start_b"),
        (F.max("at_a") - F.min("at_a") + SPAN).alias("length"), F.count("*").alias("n_anchors"),
    ).where(F.col("n_anchors") >= least).drop("offset", "_run")


def edited_fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of every text and of its edited text, with their likeness and that to the next document.

    The edited text has its last quarter (rounded down, code points) replaced by the first as many, or all, of the next
    document in ascending id order; the first follows the last.  Null ids come first, documents with the same id go by
    a hash of id and text, and repeated rows of one id and text hold one place in that order but have a row each.  Null
    texts are empty; an empty text's fingerprint is like an empty one's only.
    """
    row = [F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.col("text")]
    own = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "doc_id", F.xxhash64(*row).alias("k1"), F.xxhash64(F.lit(1), *row).alias("k2"), "text")
    keys = own.groupBy("doc_id", "k1", "k2").agg(F.count("*").alias("copies"), F.first(F.char_length("text")).alias("n_chars"))
    order = stored(numbered(keys, "place", ["doc_id", "k1", "k2"]).withColumn("place", F.col("place") - 1), "reading-order")
    n_places = order.count()

    # The front that a document takes of the next one goes there with all that is known of the taker; whole texts are
    # dealt once, by their keys.
    texts = own.groupBy("k1", "k2").agg(F.first("text").alias("text"))
    takers = order.withColumnsRenamed({"k1": "b1", "k2": "b2"}).withColumn("next", (F.col("place") + 1) % F.lit(max(n_places, 1)))
    asked = takers.join(order.select(F.col("place").alias("next"), "k1", "k2"), "next").drop("next")
    lent = texts.join(asked, ["k1", "k2"]).select(
        F.col("b1").alias("k1"), F.col("b2").alias("k2"), "doc_id", "place", "copies", "n_chars",
        F.substring(F.col("text"), F.lit(1), F.floor(F.col("n_chars") / 4).cast("int")).alias("new_tail"))
    cut = texts.join(lent, ["k1", "k2"]).withColumn("n_kept", F.col("n_chars") - F.floor(F.col("n_chars") / 4).cast("int"))
    head = F.substring(F.col("text"), F.lit(1), F.col("n_kept"))
    edge = F.substring(head, F.greatest(F.col("n_kept") - (SPAN - 2), F.lit(1)), F.lit(SPAN))  # where a run may reach the tail
    parts = cut.select(
        "doc_id", "place", "copies", "n_chars", "text", F.concat(head, "new_tail").alias("edited"), sketch(head).alias("kept"),
        sketch(F.concat(edge, F.substring(F.col("text"), F.col("n_kept") + 1, F.col("n_chars")))).alias("old"),
        sketch(F.concat(edge, "new_tail")).alias("new"))
    prints = parts.select(
        "doc_id", "place", "copies", "n_chars", F.unhex(F.sha2("edited", 256)).alias("digest"),
        fingerprint(F.col("text"), smallest(F.concat("kept", "old"))).alias("sketch"),
        fingerprint(F.col("edited"), smallest(F.concat("kept", "new"))).alias("edited_sketch"))

    # Neighbours meet in blocks of places; the first of a block is also shown to the block before it.
    def seen(place: Column, block: Column, shown: bool) -> Column:
        return F.struct(place.alias("at"), block.cast("long").alias("block"), F.lit(shown).alias("shown"))

    place = F.col("place")
    after = F.when(place == 0, seen(F.lit(n_places).cast("long"), F.floor(F.lit(n_places - 1) / BLOCK), True)).when(
        place % BLOCK == 0, seen(place, F.floor(place / BLOCK) - 1, True))
    twice = prints.select("*", F.inline(F.array_compact(F.array(seen(place, F.floor(place / BLOCK), False), after))))
    following = Window.partitionBy("block").orderBy("at").rangeBetween(1, 1)
    met = twice.withColumn("next_sketch", F.first("sketch").over(following)).where(~F.col("shown"))
    judged = met.select(
        "doc_id", "copies", F.col("n_chars").cast("long").alias("n_chars"), F.lower(F.hex("digest")).alias("edited_sha256"),
        printed(F.col("sketch")).alias("fingerprint"), printed(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
    return judged.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copy", "copies")
